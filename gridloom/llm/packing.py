"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

A sequence is filled from the front: of the examples that still fit, the one with the largest dot product of its
demand and of the room that is left, both in parts of the limits, goes in next. Examples with equal
demands are one class with a count, so a step looks at classes, of which there are few, not at examples.
When nothing fits, the room that is left is filled by cutting the longest example, if both pieces
are long enough. Every task packs what it reads and keeps only a bounded number of ids at a time; no
shuffle is needed, and a lost task is packed again in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices
from gridloom.llm.tokens import crc32, default_path, encoded


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most, and the shortest piece that a cut may leave."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048
    least_piece: int = 8


@dataclass
class Piece:
    """Ids `start` and following of a document; `loss` marks ids that bear loss, all where it is None."""

    doc: object
    start: int
    ids: np.ndarray
    doc_tokens: int
    loss: np.ndarray | None = None

    def demand(self) -> tuple[int, int]:
        return len(self.ids), len(self.ids) if self.loss is None else int(self.loss.sum())

    def cut(self, at: int) -> tuple["Piece", "Piece"]:
        loss = (None, None) if self.loss is None else (self.loss[:at], self.loss[at:])
        return Piece(self.doc, self.start, self.ids[:at], self.doc_tokens, loss[0]), Piece(self.doc, self.start + at, self.ids[at:], self.doc_tokens, loss[1])


class Packer:
    """Sequences of pieces, made as pieces are added."""

    def __init__(self, limits: Limits) -> None:
        self.limits = limits
        self.classes: dict[tuple[int, int], list[Piece]] = {}
        self.waiting = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Take a piece of any length; parts that fill a sequence alone come back as sequences."""
        most = self.limits.tokens
        while len(piece.ids) > 0:
            until = min(most, len(piece.ids))
            if piece.loss is not None:
                until = min(until, int(np.searchsorted(np.cumsum(piece.loss), self.limits.loss, "right")))
            else:
                until = min(until, self.limits.loss)
            head, piece = piece.cut(max(1, until))
            if len(head.ids) == most:
                yield [head]
            else:
                self.classes.setdefault(head.demand(), []).append(head)
                self.waiting += len(head.ids)

    def sequences(self, all_of_them: bool) -> Iterator[list[Piece]]:
        """Pack what is waiting; unless all of it is wanted, stop when no full sequence is left."""
        demands = np.array(sorted(self.classes), np.int64).reshape(-1, 2)
        counts = np.array([len(self.classes[tuple(d)]) for d in demands.tolist()], np.int64)
        limit = np.array([self.limits.tokens, self.limits.loss], float)
        parts = demands / limit
        while self.waiting >= (1 if all_of_them else self.limits.tokens):
            room, segments, bin_ = np.array([self.limits.tokens, self.limits.loss]), self.limits.segments, []
            while segments and room[0]:
                fits = (counts > 0) & (demands[:, 0] <= room[0]) & (demands[:, 1] <= room[1])
                if not fits.any():
                    break
                gain = parts @ (room / limit) + segments / self.limits.segments**2
                best = int(np.argmax(np.where(fits, gain, -1.0)))
                piece = self.classes[tuple(demands[best].tolist())].pop()
                counts[best] -= 1
                room = room - demands[best]
                segments -= 1
                bin_.append(piece)
            least = self.limits.least_piece
            if segments and room[0] >= least:
                longer = np.flatnonzero((counts > 0) & (demands[:, 0] >= room[0] + least))
                if len(longer):
                    best = int(longer[-1])
                    whole = self.classes[tuple(demands[best].tolist())].pop()
                    counts[best] -= 1
                    head, tail = whole.cut(int(room[0]))
                    if head.demand()[1] <= room[1]:
                        bin_.append(head)
                        put_back = tail
                    else:
                        put_back = whole
                    to = put_back.demand()
                    self.classes.setdefault(to, []).append(put_back)
                    at = np.flatnonzero((demands == to).all(1))
                    if len(at):
                        counts[at[0]] += 1
                    else:
                        place = int(np.searchsorted(demands[:, 0] * (self.limits.loss + 1) + demands[:, 1], to[0] * (self.limits.loss + 1) + to[1]))
                        demands, counts = np.insert(demands, place, to, 0), np.insert(counts, place, 1)
                        parts = demands / limit
            self.waiting -= sum(len(p.ids) for p in bin_)
            yield bin_
        self.classes = {d: pieces for d, pieces in self.classes.items() if pieces}


#: Waiting ids at which a task packs.
IDS_AT_ONCE = 1 << 21
COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _rows(sequence: list[Piece], number: int) -> Iterator[tuple]:
    at = 0
    for piece in sequence:
        yield piece.doc, piece.start, len(piece.ids), crc32(piece.ids), piece.doc_tokens, number, at
        at += len(piece.ids)


def packed(rows: DataFrame, pieces: Callable[[pa.RecordBatch], Iterator[Piece]], key: str, key_type: str, limits: Limits) -> DataFrame:
    """Pack the pieces that `pieces` makes of each batch of `rows`; one row per piece in a sequence."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(f"`{key}` {key_type}, {COLUMNS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, number = Packer(limits), TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def put(sequences: Iterator[list[Piece]]) -> None:
            nonlocal number
            for sequence in sequences:
                out.extend(_rows(sequence, number))
                number += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 7
            batch = pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])], schema.names)
            out.clear()
            return batch

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for piece in pieces(batch):
                put(packer.add(piece))
                if packer.waiting >= IDS_AT_ONCE:
                    put(packer.sequences(False))
            yield flush()
        if kind is not None:
            put(packer.sequences(True))
            yield flush()

    return rows.mapInArrow(run, schema)


def packed_documents(docs: DataFrame, path: str | None = None, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents, each as its ids with the end id.

    One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is its
    end id; repeated rows and null keys are packed like any other; an empty table gives no rows. Other columns
    are not looked at.
    """
    path = path or default_path()

    def pieces(batch: pa.RecordBatch) -> Iterator[Piece]:
        for part in slices(batch, 1):
            for one, ids in zip(part.column(0).to_pylist(), encoded(part.column(1).to_pylist(), path)):
                yield Piece(one, 0, ids, len(ids))

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("__text"))
    return packed(rows, pieces, key, docs.schema[key].dataType.simpleString(), limits)


def packed_conversations(
    turns: DataFrame, path: str | None = None, limits: Limits = Limits(segments=32, loss=1536), key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", answers: str = "assistant"
) -> DataFrame:
    """Pack instruction data: an example is a conversation, its turns in order; ids of `answers` turns bear loss.

    Turns are gathered per conversation, whose length is bounded by the dialogue, not by the table. A null text is its end
    id, a null role is no answer, null turns come first; rows without a key are one conversation; repeated turns stay; an
    empty table gives no rows. Other columns are not looked at.
    """
    path = path or default_path()
    gathered = turns.groupBy(F.col(key)).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), (F.col(role) == answers).alias("answer"), F.coalesce(F.col(text), F.lit("")).alias("text")))).alias("turns")
    )

    def pieces(batch: pa.RecordBatch) -> Iterator[Piece]:
        for one, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = list(encoded([p["text"] for p in parts], path))
            loss = np.concatenate([np.full(len(x), bool(p["answer"])) for x, p in zip(ids, parts)])
            joined = np.concatenate(ids)
            yield Piece(one, 0, joined, len(joined), loss)

    return packed(gathered, pieces, key, turns.schema[key].dataType.simpleString(), limits)
