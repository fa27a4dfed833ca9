"""Line deduplication by a sharded minimal perfect hash over the distinct line hashes.

1. A worker turns the long lines of about a megabyte of documents into 128-bit hashes of their keys, distinct in each
   document, and stores them as one row, a slice.
2. Counts: a slice sends each hash once, with the number of its documents and the largest id; they are summed by hash.
3. The distinct hashes are dealt over shards. In each, a minimal perfect hash gives every hash a slot: level by level, a
   hash alone at its place in a bit array has its slot there, the others go on to the next level. Arrays by slot hold a
   32-bit fingerprint and the count; the holder, the largest id, is kept for slots whose count reaches the limit only.
4. Slices probe the shards: again each hash once per slice, so a line that a third of all documents hold is probed once a slice.
   A shard with many probes has several copies of its arrays, each probed by its share of the slices.
5. The few answers (a hash and its holder) go back to the slice, which knows the documents of each hash.

No line meets another one by a join, and only the texts of documents travel, once, to meet the hashes that they lose.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import as_bytes, slices, written
from gridloom.session import shuffle_width

BLANKS = b" \t\n\v\f\r"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
FOLLOWING = bytes(range(0x80, 0xC0))
#: Distinct hashes of a shard, and probes of one copy of its arrays.
HASHES_PER_SHARD = 1 << 20
PROBES_PER_COPY = 1 << 20
#: Stands for a null key, below every other one.
NO_KEY = -(1 << 63)
HASH = np.dtype([("hi", "<u8"), ("lo", "<u8")])


@dataclass(frozen=True)
class Limits:
    """Keys of `characters` code points or more that `documents` or more hold are dropped."""

    characters: int = 40
    documents: int = 5


def line_keys(raw: bytes, characters: int) -> list[bytes | None]:
    """The key of each line of a text; None where it is too short."""
    found: list[bytes | None] = []
    for line in raw.translate(LOWER).split(b"\n"):
        one = line.strip(BLANKS)
        long = len(one) >= characters and (one.isascii() or len(one.translate(None, FOLLOWING)) >= characters)
        found.append(one if long else None)
    return found


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _ordered(hashes: np.ndarray) -> np.ndarray:
    return np.lexsort((hashes["lo"], hashes["hi"]))


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins in ordered hashes."""
    changed = (ordered["hi"][1:] != ordered["hi"][:-1]) | (ordered["lo"][1:] != ordered["lo"][:-1])
    return np.flatnonzero(np.r_[len(ordered) > 0, changed])


class PerfectHash:
    """Slots 0 .. n - 1 for n distinct 128-bit hashes; any other hash gets some slot or none (-1)."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks: list[np.ndarray] = []
        before = 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(before + np.cumsum(ones) - ones)
            before += int(ones.sum())
        self.size = before

    @staticmethod
    def _place(hashes: np.ndarray, level: int, words: int) -> np.ndarray:
        return _mixed(hashes["hi"] + hashes["lo"] * np.uint64(2 * level + 1)) % np.uint64(64 * words)

    @classmethod
    def over(cls, hashes: np.ndarray) -> "PerfectHash":
        levels: list[np.ndarray] = []
        while len(hashes):
            words = len(hashes) // 32 + 1  # two places for each hash
            place = cls._place(hashes, len(levels), words).astype(np.int64)
            alone = np.bincount(place, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            hashes = hashes[~alone[place]]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        found = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks)):
            place = self._place(hashes[open_], level, len(words))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            here = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[open_[here]] = (ranks[word] + np.bitwise_count(below))[here]
            open_ = open_[~here]
        return found


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """32 bits of each hash that its place does not follow from."""
    return (_mixed(hashes["lo"] ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype("<u4")


INDEX = "levels array<binary>, prints binary, counts binary, count_bytes int, shared binary, holders binary"


def index_of(hashes: np.ndarray, counts: np.ndarray, holders: np.ndarray, documents: int) -> dict:
    """The arrays of a shard: fingerprint and count by slot, and the holders of the slots with enough documents."""
    perfect = PerfectHash.over(hashes)
    slot = perfect.slots(hashes)
    prints, by_slot, holder = np.zeros(len(hashes), "<u4"), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), "<i8")
    prints[slot], by_slot[slot], holder[slot] = fingerprints(hashes), counts, holders
    narrow = by_slot.astype(np.min_scalar_type(int(counts.max(initial=0))).newbyteorder("<"))
    shared = np.flatnonzero(by_slot >= documents)
    return {
        "levels": [x.tobytes() for x in perfect.levels], "prints": prints.tobytes(), "counts": narrow.tobytes(),
        "count_bytes": narrow.itemsize, "shared": shared.astype("<i8").tobytes(), "holders": holder[shared].tobytes(),
    }


def probed(index: dict, hashes: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """(which of `hashes` reach the limit, their holders)."""
    slot = PerfectHash([np.frombuffer(x, "<u8") for x in index["levels"]]).slots(hashes)
    known = np.flatnonzero(slot >= 0)
    known = known[np.frombuffer(index["prints"], "<u4")[slot[known]] == fingerprints(hashes[known])]
    counts = np.frombuffer(index["counts"], f"<u{index['count_bytes']}")
    reach = known[counts[slot[known]] >= documents]
    at = np.searchsorted(np.frombuffer(index["shared"], "<i8"), slot[reach])
    return reach, np.frombuffer(index["holders"], "<i8")[at]


def _slices(docs: DataFrame, limits: Limits) -> DataFrame:
    """(slice, docs, hashes): pairs of a document's key and a distinct hash of its long lines, a row per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 1):
                keys, hashes = [], []
                for one, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = {xxhash.xxh3_128_digest(k) for k in line_keys(raw, limits.characters) if k is not None}
                    keys += [one] * len(own)
                    hashes += own
                if keys:
                    yield pa.RecordBatch.from_pydict({"slice": [number], "docs": [np.array(keys, "<i8").tobytes()], "hashes": [b"".join(hashes)]}, schema=SLICE)
                    number += 1

    return docs.mapInArrow(run, "slice long, docs binary, hashes binary")


SLICE = pa.schema([("slice", pa.int64()), ("docs", pa.binary()), ("hashes", pa.binary())])


def _counted(lines: DataFrame) -> DataFrame:
    """(hi, lo, n, holder) of the distinct hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, raw in zip(batch.column(0), batch.column(1)):
                hashes = np.frombuffer(raw.as_py(), HASH)
                order = _ordered(hashes)
                begin = _starts(hashes[order])
                n = np.diff(np.r_[begin, len(order)])
                holder = np.maximum.reduceat(np.frombuffer(docs.as_py(), "<i8")[order], begin)
                hi, lo = (hashes[c][order[begin]].view("<i8") for c in ("hi", "lo"))
                yield pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(n), pa.array(holder)], ["hi", "lo", "n", "holder"])

    sent = lines.select("docs", "hashes").mapInArrow(run, "hi long, lo long, n long, holder long")
    return sent.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("holder").alias("holder"))


def _shard_of(shards: int):
    return F.pmod(F.col("lo"), F.lit(shards)).cast("int")


def _indexes(counted: DataFrame, shards: int, documents: int) -> DataFrame:
    """(shard, the arrays of its index)."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        hashes = np.empty(group.num_rows, HASH)
        hashes["hi"], hashes["lo"] = (group.column(c).to_numpy().view("<u8") for c in ("hi", "lo"))
        made = index_of(hashes, group.column("n").to_numpy(), group.column("holder").to_numpy(), documents)
        return pa.Table.from_pylist([{"shard": key[0].as_py()} | made], schema=INDEX_ARROW)

    return counted.withColumn("shard", _shard_of(shards)).groupBy("shard").applyInArrow(build, f"shard int, {INDEX}")


INDEX_ARROW = pa.schema([
    ("shard", pa.int32()), ("levels", pa.list_(pa.binary())), ("prints", pa.binary()), ("counts", pa.binary()),
    ("count_bytes", pa.int32()), ("shared", pa.binary()), ("holders", pa.binary()),
])
ANSWER = pa.schema([("slice", pa.int64()), ("hashes", pa.binary()), ("holders", pa.binary())])


def _probes(lines: DataFrame, shards: int, copies: np.ndarray) -> DataFrame:
    """(shard, copy, slice, hashes): the distinct hashes of a slice, by the shard that knows them."""
    sent = lines.sparkSession.sparkContext.broadcast(copies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = np.frombuffer(raw.as_py(), HASH)
                hashes = hashes[_ordered(hashes)]
                hashes = hashes[_starts(hashes)]
                shard = (hashes["lo"].view("<i8") % shards).astype(np.int32)
                order = np.argsort(shard, kind="stable")
                hashes, shard = hashes[order], shard[order]
                begin = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
                own = shard[begin]
                chosen = (np.int64(number ^ number >> 40) % sent.value[own]).astype(np.int32)
                parts = [x.tobytes() for x in np.split(hashes, begin[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(chosen), pa.array([number] * len(own), pa.int64()), pa.array(parts, pa.binary())], ["shard", "copy", "slice", "hashes"])

    return lines.select("slice", "hashes").mapInArrow(run, "shard int, copy int, slice long, hashes binary")


def _answers(probes: DataFrame, indexes: DataFrame, documents: int) -> DataFrame:
    """(slice, hashes, holders) of the probed hashes that enough documents hold."""

    def probe(known: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return ANSWER.empty_table()
        sizes = [len(x.as_py()) // HASH.itemsize for x in asked.column("hashes")]
        hashes = np.frombuffer(b"".join(asked.column("hashes").to_pylist()), HASH)
        reach, holders = probed(known.to_pylist()[0], hashes, documents)
        row = np.repeat(np.arange(len(sizes)), sizes)[reach]
        found = np.unique(row)
        begin, end = np.searchsorted(row, found), np.searchsorted(row, found, "right")
        numbers = asked.column("slice").to_numpy()[found]
        return pa.Table.from_pydict({"slice": numbers, "hashes": [hashes[reach[a:b]].tobytes() for a, b in zip(begin, end)], "holders": [holders[a:b].tobytes() for a, b in zip(begin, end)]}, schema=ANSWER)

    return indexes.groupBy("shard", "copy").cogroup(probes.groupBy("shard", "copy")).applyInArrow(probe, "slice long, hashes binary, holders binary")


def _dropped(lines: DataFrame, answers: DataFrame) -> DataFrame:
    """(doc, drops): the hashes that each document loses, joined."""

    def settle(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not known.num_rows:
            return DROPS.empty_table()
        hashes = np.frombuffer(b"".join(known.column("hashes").to_pylist()), HASH)
        holders = np.frombuffer(b"".join(known.column("holders").to_pylist()), "<i8")
        holder_of = dict(zip(hashes.tolist(), holders.tolist()))
        docs = np.frombuffer(asked.column("docs")[0].as_py(), "<i8")
        own = np.frombuffer(asked.column("hashes")[0].as_py(), HASH)
        lost = np.array([i for i, (h, doc) in enumerate(zip(own.tolist(), docs.tolist())) if holder_of.get(h, doc) != doc], np.int64)
        lost = lost[np.argsort(docs[lost], kind="stable")]
        found, begin = np.unique(docs[lost], return_index=True)
        return pa.Table.from_pydict({"doc": found, "drops": [own[x].tobytes() for x in np.split(lost, begin[1:])] if len(found) else []}, schema=DROPS)

    return lines.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(settle, "doc long, drops binary")


DROPS = pa.schema([("doc", pa.int64()), ("drops", pa.binary())])


def without_shared_lines(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, n_lines, n_dropped) of every row, its text without the lines that other documents hold, too.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Lines whose key has enough code points
    and stands in enough documents go from all but the document with the largest key, which keeps all of
    them. Each row is a document, repeated rows, too; rows with the same key keep or lose the same lines. A null
    key is below all others. A null text is empty: one empty line. An empty table gives no rows. `key` is a
    column of whole numbers; other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("doc"), as_bytes(text).alias("raw"))
    lines = written(_slices(rows, limits), "line-slices")
    counted = written(_counted(lines), "line-counts")
    shards = max(shuffle_width(spark), -(-counted.count() // HASHES_PER_SHARD))
    asked = counted.groupBy(_shard_of(shards).alias("shard")).agg(F.sum("n").alias("n")).where(F.col("n") > PROBES_PER_COPY)
    copies = np.ones(shards, np.int64)
    for row in asked.collect():  # a number per shard at most
        copies[row.shard] = -(-row.n // PROBES_PER_COPY)
    many = spark.createDataFrame([(int(s), int(copies[s])) for s in np.flatnonzero(copies > 1)], "shard int, copies int")
    indexes = written(_indexes(counted, shards, limits.documents), "line-indexes").join(many, "shard", "left")
    indexes = indexes.withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    answers = written(_answers(_probes(lines, shards, copies), indexes, limits.documents), "line-answers")
    dropped = _dropped(lines, answers).groupBy("doc").agg(F.collect_set("drops").alias("drops"))
    # By shuffle at every size: what documents lose grows with them, so it is never sent to all tasks.
    met = rows.join(written(dropped, "line-drops").hint("merge"), "doc", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts, counts, gone = [], [], []
                for raw, drops in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    lines = raw.split(b"\n")
                    counts.append(len(lines))
                    if drops:
                        lost = {x[i : i + HASH.itemsize] for x in drops for i in range(0, len(x), HASH.itemsize)}
                        keys = line_keys(raw, limits.characters)
                        lines = [line for line, k in zip(lines, keys) if k is None or xxhash.xxh3_128_digest(k) not in lost]
                    gone.append(counts[-1] - len(lines))
                    texts.append(b"\n".join(lines))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary()), pa.array(counts), pa.array(gone)], ["doc", "raw", "n_lines", "n_dropped"])

    kept = met.select("doc", "raw", "drops").mapInArrow(run, "doc long, raw binary, n_lines long, n_dropped long")
    return kept.select(F.nullif("doc", F.lit(NO_KEY)).alias(key), F.col("raw").cast("string").alias(text), "n_lines", "n_dropped")


def line_digests(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`without_shared_lines` with the SHA-256 of the kept text in its place."""
    kept = without_shared_lines(docs, limits, key, text)
    return kept.select(key, "n_lines", "n_dropped", F.sha2(F.col(text).cast("binary"), 256).alias("kept_sha256"))
