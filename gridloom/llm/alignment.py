"""Alignment of the tokens of two tokenizers over the same bytes.

A byte-level vocabulary (A) encodes a space and the text, a piece vocabulary (B) the text, before which it sets a space itself.
Byte offsets at which tokens of both end cut the tokens into groups; the last tokens of a group end together and are linked.

An identity map names for each A-id the B-id with the same bytes. Groups of one A-token and the B-token that the map names,
the great majority, are counted by A-id in vectors as long as the vocabulary, one per task. Only the links of the
other, irregular groups are counted as pairs by a shuffle, after each task has summed its own.

In texts whose white space is spaces and line feeds, neither tokenizer has a token that goes from other characters on to white space, nor
from a word to a mark that ends it. So both cut there; a run of white space with the word behind it, or the mark and what
follows it, is aligned once and kept by the worker. Every other text is encoded as a whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices, written

BLANK = "▁"
LETTER, MARK = "[A-Za-zÀ-ÖØ-öø-ɏ]", "[.,;:!?]"
CHUNK = re.compile(f"\\s+(?:{LETTER}+(?={MARK})|\\S*)|\\S+")
ODD_BLANKS = re.compile(f"[^\\S \n]|{BLANK}")
#: Bytes of aligned chunks that a worker keeps; later ones are aligned each time that they come up.
CACHED_BYTES = 40 << 20
#: Pairs that every task knows the count of, the most frequent ones. Another pair holds less than this part of all irregular links.
KNOWN_PAIRS = 1 << 17


@dataclass(frozen=True)
class Paths:
    """The vocabulary files of A (for the tokenizers library) and B (for sentencepiece)."""

    a: str
    b: str


def default_paths() -> Paths:
    import public_tokenizers

    return Paths(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the identity map."""

    def __init__(self, paths: Paths) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(paths.a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths.b)
        letters = byte_of_letter()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_length = np.array([len(x) for x in self.a_bytes])
        self.b_length = np.array([len(x) for x in self.b_bytes])
        plain: dict[bytes, int] = {}
        for number in sorted(range(len(self.b_bytes)), key=lambda i: (self.b.is_byte(i), i)):
            if not self.b.is_control(number) and not self.b.is_unknown(number):
                plain.setdefault(self.b_bytes[number], number)
        self.same = np.array([plain.get(x, -1) for x in self.a_bytes], np.int64)
        a_text, b_text = ([str(i).encode() for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))
        #: Whether no token goes on from other characters to white space, from a line feed to anything, or from a word to a mark.
        across = re.compile(f"[^{BLANK}]{BLANK}|\n.|.\n|{LETTER}{MARK}")
        self.cuts = not any(across.search(self.b.id_to_piece(i)) for i in range(len(self.b_bytes)))
        self.written = [*(x + b"," for x in a_text), *(x + b"|" for x in a_text), *(x + b"," for x in b_text), *(x + b";" for x in b_text)]

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace(BLANK, " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A-ids of a space and the text, B-ids of the text) of each text."""
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        b = self.b.encode(texts, num_threads=1)
        return [(np.array(x.ids, np.int64), np.array(y, np.int64)) for x, y in zip(a, b)]

    def spell(self, a: np.ndarray, b: np.ndarray) -> tuple[bytes, bytes]:
        return b"".join(map(self.a_bytes.__getitem__, a.tolist())), b"".join(map(self.b_bytes.__getitem__, b.tolist()))


class Aligned(NamedTuple):
    """A text or a part of one: tokens, groups, their written form, A-ids of exact groups, pairs (A << 32 | B) of the others."""

    n_a: int
    n_b: int
    n_groups: int
    groups: bytes
    exact: bytes
    pairs: bytes

    def size(self) -> int:
        return 330 + len(self.groups) + len(self.exact) + len(self.pairs)



def align(v: Vocabularies, a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> list[Aligned]:
    """The parts of a text that end at the byte offsets `cuts`, all of them common ends; both tokens spell the same bytes."""
    a_end, b_end = np.cumsum(v.a_length[a]), np.cumsum(v.b_length[b])
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    a_until, b_until = np.searchsorted(a_end, common, "right"), np.searchsorted(b_end, common, "right")
    a_size, b_size = np.diff(a_until, prepend=0), np.diff(b_until, prepend=0)
    last_a, last_b = a[a_until - 1], b[b_until - 1]
    exact = (a_size == 1) & (b_size == 1) & (v.same[last_a] == last_b)
    # Written form: the tokens of a group side by side, each with the mark after it.
    n_a, n_b = len(v.a_bytes), len(v.b_bytes)
    codes = np.empty(len(a) + len(b), np.int64)
    a_place = np.arange(len(a)) + np.repeat(b_until - b_size, a_size)
    b_place = np.arange(len(b)) + np.repeat(a_until, b_size)
    codes[a_place], codes[b_place] = a, 2 * n_a + b
    codes[a_place[a_until - 1]] += n_a
    codes[b_place[b_until - 1]] += n_b
    at = np.searchsorted(common, cuts, "right")  # groups up to each cut
    token = (a_until + b_until)[at - 1]
    exact_ids, exact_until = last_a[exact].astype("<u4"), np.r_[0, np.cumsum(exact)][at]
    pairs, pair_until = (last_a << 32 | last_b)[~exact].astype("<i8"), np.r_[0, np.cumsum(~exact)][at]
    words = list(map(v.written.__getitem__, codes.tolist()))
    out, begin = [], (0, 0, 0, 0, 0, 0)
    for end in zip(a_until[at - 1].tolist(), b_until[at - 1].tolist(), at.tolist(), token.tolist(), exact_until.tolist(), pair_until.tolist()):
        out.append(Aligned(end[0] - begin[0], end[1] - begin[1], end[2] - begin[2], b"".join(words[begin[3] : end[3]])[:-1], exact_ids[begin[4] : end[4]].tobytes(), pairs[begin[5] : end[5]].tobytes()))
        begin = end
    return out


class Aligner:
    """Aligns texts; keeps the chunks that it has met."""

    def __init__(self, paths: Paths) -> None:
        self.v = Vocabularies(paths)
        self.known: dict[str, Aligned | None] = {}
        self.held = 0

    def align(self, texts: list[str]) -> list[list[Aligned]]:
        """The parts of each text; none where the tokens do not spell it."""
        chunks = [None if not t or not self.v.cuts or ODD_BLANKS.search(t) else CHUNK.findall(" " + t) for t in texts]
        new = [c for c in set().union(*(row for row in chunks if row)) if c not in self.known]
        self.known.update(zip(new, self._chunks(new)))
        take = self.known.__getitem__
        found = [list(map(take, row)) if row else [None] for row in chunks]
        for chunk in new:
            made = self.known[chunk]
            size = made.size() + 4 * len(chunk) if made else CACHED_BYTES
            if self.held + size > CACHED_BYTES:  # what is beyond the bound leaves again
                del self.known[chunk]
            else:
                self.held += size
        return [self._whole(text) if None in parts else parts for text, parts in zip(texts, found)]

    def _whole(self, text: str) -> list[Aligned]:
        if not text:
            return []
        ((a, b),) = self.v.encode([text])
        raw = b" " + text.encode()
        return align(self.v, a, b, np.array([len(raw)])) if self.v.spell(a, b) == (raw, raw) else []

    def _chunks(self, chunks: list[str]) -> list[Aligned | None]:
        """Many chunks in one call: set one after the other they are a text again. None where a chunk is not spelled."""
        row = [c for c in chunks if not c[-1].isspace()]  # white space at the end would go on into the next one
        spaced = [part for c in row for part in ((c,) if c[0].isspace() else (" a", c))]  # a mark stands behind a word
        joined = "a" + "".join(spaced)
        made: dict[str, Aligned | None] = {}
        raw = b" " + joined.encode()
        ((a, b),) = self.v.encode([joined])
        if self.v.spell(a, b) == (raw, raw):
            parts = align(self.v, a, b, np.cumsum([2, *(len(c.encode()) for c in spaced)]))[1:]
            made = {c: p for c, p in zip(spaced, parts)}
        for chunk in chunks:
            if chunk not in made:
                made[chunk] = self._alone(chunk)
        return [made[c] for c in chunks]

    def _alone(self, chunk: str) -> Aligned | None:
        raw = b" a" + chunk.encode()
        ((a, b),) = self.v.encode(["a" + chunk])
        return align(self.v, a, b, np.array([2, len(raw)]))[1] if self.v.spell(a, b) == (raw, raw) else None


_ALIGNERS: dict[Paths, Aligner] = {}


def aligner(paths: Paths) -> Aligner:
    """The worker's aligner; it stays for later tasks."""
    if paths not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[paths] = Aligner(paths)
    return _ALIGNERS[paths]


ROW = pa.schema([
    ("row", pa.int64()), ("key", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("exact", pa.binary()), ("pairs", pa.binary()),
])


def aligned_rows(docs: DataFrame, paths: Paths, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, n_a, n_b, n_groups, groups_sha256, exact, pairs): a row's tokens, groups and links; `row` numbers the rows.

    exact: A-ids of the exact groups as unsigned 32-bit integers; pairs: the links of the others, A << 32 | B.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number = aligner(paths), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 1):
                rows = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for one, parts in zip(part.column(0).to_pylist(), tool.align(texts)):
                    digest = hashlib.sha256(b";".join(p.groups for p in parts)).hexdigest() if parts else ""
                    n_a, n_b, n_groups = sum(p.n_a for p in parts), sum(p.n_b for p in parts), sum(p.n_groups for p in parts)
                    rows.append((number, one, n_a, n_b, n_groups, digest, b"".join([p.exact for p in parts]), b"".join([p.pairs for p in parts])))
                    number += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), ROW.types)], schema=ROW)

    frame = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return frame.mapInArrow(run, "row long, key long, n_a long, n_b long, n_groups long, groups_sha256 string, exact binary, pairs binary")


def exact_counts(rows: DataFrame, size: int) -> np.ndarray:
    """How many exact groups each A-id has: a vector per task, summed by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                total += np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), "<u4"), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    out = np.zeros(size, np.int64)
    for row in rows.select("exact").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # as many as ids
        out[row.id] = row.n
    return out


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n) of the links of irregular groups; a task sums what it holds before it sends it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, 8 << 20):
                pairs, n = np.unique(np.frombuffer(b"".join(part.column(0).to_pylist()), "<i8"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

    return rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def link_counts(rows: DataFrame, paths: Paths) -> DataFrame:
    """(a_id, b_id, n) of all links of `aligned_rows`: the alignment table of the two vocabularies."""
    v = aligner(paths).v
    exact = exact_counts(rows, len(v.a_bytes))
    known = [(int(i), int(v.same[i]), int(exact[i])) for i in np.flatnonzero(exact)]  # one per id at most
    regular = rows.sparkSession.createDataFrame(known, "a_id long, b_id long, n long")
    return regular.unionByName(pair_counts(rows).select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b_id"), "n"))


def token_links(docs: DataFrame, paths: Paths | None = None, key: str = "doc_id", text: str = "text", known_pairs: int = KNOWN_PAIRS) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A pair's count is how many links of the corpus have it. n_best: links whose count no other pair with their B-id exceeds;
    count_sum: the sum of the counts over the row's links. A text that is null or empty, or that one of the
    tokenizers does not give back byte by byte, has no tokens: zeros, and an empty groups_sha256. Rows are aligned one
    by one: repeated rows come back as often and count as often, null keys stay, an empty table gives no rows. Other columns
    are not looked at.
    """
    paths = paths or default_paths()
    spark = docs.sparkSession
    rows = written(aligned_rows(docs, paths, key, text), "alignments")
    v = aligner(paths).v
    exact = exact_counts(rows, len(v.a_bytes))
    counts = written(pair_counts(rows), "pair-counts")
    best = np.zeros(len(v.b_bytes), np.int64)
    at = np.flatnonzero(exact)
    np.maximum.at(best, v.same[at], exact[at])
    for row in counts.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("n").alias("n")).collect():  # as many as ids
        best[row.b] = max(best[row.b], row.n)
    top = sorted((row.pair, row.n) for row in counts.orderBy(F.desc("n"), "pair").limit(known_pairs).collect())
    tables = spark.sparkContext.broadcast((exact, v.same, best, np.array([p for p, _ in top], np.int64), np.array([n for _, n in top], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, same, best, pairs, counted = tables.value
        is_best = exact == best[same]
        for batch in batches:
            for part in slices(batch, 5, 1 << 22):
                n_best, count_sum, rest = [], [], []
                for ids, own in zip(part.column(5), part.column(6)):
                    a, p = np.frombuffer(ids.as_py(), "<u4"), np.frombuffer(own.as_py(), "<i8")
                    good, total = int(is_best[a].sum()), int(exact[a].sum())
                    if len(p):
                        place = np.minimum(np.searchsorted(pairs, p), max(0, len(pairs) - 1))
                        found = pairs[place] == p if len(pairs) else np.zeros(len(p), bool)
                        n = counted[place[found]] if len(pairs) else np.zeros(0, np.int64)
                        good, total, p = good + int((n == best[p[found] & 0xFFFFFFFF]).sum()), total + int(n.sum()), p[~found]
                    n_best.append(good)
                    count_sum.append(total)
                    unknown, times = np.unique(p, return_counts=True)
                    rest.append([{"pair": x, "times": t} for x, t in zip(unknown.tolist(), times.tolist())])
                columns = [*(part.column(i) for i in (0, 1, 2, 3, 4, 7)), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(rest, REST)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "key", "n_a", "n_b", "n_groups", "groups_sha256", "n_best", "count_sum", "rest"])

    types = "row long, key long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long, rest array<struct<pair: bigint, times: bigint>>"
    met = rows.select("row", "key", "n_a", "n_b", "n_groups", "exact", "pairs", "groups_sha256").mapInArrow(run, types)
    if counts.count() > known_pairs:
        met = written(met, "known-links")
        b_best = spark.createDataFrame([(i, int(n)) for i, n in enumerate(best) if n], "b long, best long")
        left = met.select("row", F.inline("rest")).join(counts, "pair").withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(b_best, "b")
        more = left.groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
        met = met.join(more, "row", "left").withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
    return met.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")


REST = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
