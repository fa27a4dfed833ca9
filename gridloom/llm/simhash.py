"""SimHash fingerprints and their near-duplicate groups by a Gray-order hierarchical index.

Two fingerprints that differ in two bits at most agree on one of three blocks of bits. The upper
nodes of the index are (mask, pattern) pairs: all fingerprints with one pattern under one mask.
A node with more fingerprints than a task should hold is refined: the bits outside its
mask are cut into three blocks again, one of which agrees too, so its children lose no link. The third
level leaves 19 free bits, which bounds a node by 2^19 fingerprints whatever the data are.
Below the upper nodes a task sorts a node's fingerprints by Gray rank, so that neighbours share long
masked patterns, builds a tree over them whose nodes hold the bits shared by all of their children and
not yet by their parent, and searches it from the top: differences add up along the path and a
whole group is left out as soon as they exceed the distance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridloom.llm.common import as_bytes, written
from gridloom.llm.graph import components

BITS = 64
DISTANCE = 2
SEED = 42
WORDS = 3
#: Fingerprints of an upper node beyond which it is refined.
NODE_LIMIT = 4096
FANOUT = 8
CHUNK = 1 << 16
QUERIES_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 18


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash over XXH64 of the word shingles, repeats included; bits set in over half of them."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends[: len(parts) - words]]
    digest = xxhash.xxh64_digest
    n = len(starts)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        raw = b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at + words - 1 : at + words - 1 + CHUNK])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, BITS)
        ones += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprint_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(text.as_py(), words) for text in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["key", "print"])

    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, print) of every row; print is the fingerprint as a signed long, 0 for a text without words."""
    rows = docs.select(F.col(key).alias("key"), as_bytes(text).alias("text"))
    return rows.mapInArrow(_fingerprint_batches(words), f"key {docs.schema[key].dataType.simpleString()}, print long")


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in the Gray sequence."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _blocks(bits: list[int]) -> list[int]:
    """Masks of three blocks of neighbouring bits."""
    cut = [0, len(bits) // 3, 2 * len(bits) // 3, len(bits)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cut, cut[1:])]


def child_masks(mask: int) -> list[int]:
    """The masks of a node's children: its own bits and one block of the others."""
    return [mask | block for block in _blocks([b for b in range(BITS) if not mask >> b & 1])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _tree(prints: np.ndarray, first: np.ndarray) -> list[dict]:
    """Levels from the leaves up; `first` marks where a node's fingerprints begin. The top has one per node."""
    shared_and, shared_or, group = prints, prints, np.cumsum(first) - 1
    levels = []
    while True:
        begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        at = np.arange(len(group)) - np.repeat(begin, np.diff(np.r_[begin, len(group)]))
        lead = np.flatnonzero(at % FANOUT == 0)
        end = np.r_[lead[1:], len(group)]
        shared_and, shared_or, group = np.bitwise_and.reduceat(shared_and, lead), np.bitwise_or.reduceat(shared_or, lead), group[lead]
        mask = ~(shared_and ^ shared_or)
        levels.append({"lead": lead, "end": end, "mask": mask, "pattern": shared_and & mask})
        if len(group) == group[-1] + 1:
            return levels


def links(prints: np.ndarray, first: np.ndarray, distance: int = DISTANCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints of one node within the distance, in blocks. Sorted by node and Gray rank."""
    if not len(prints):
        return
    levels = _tree(prints, first)
    leaf_of_top = np.arange(len(levels[-1]["lead"]))
    node_of = np.cumsum(first) - 1
    for at in range(0, len(prints), QUERIES_AT_ONCE):
        query = np.arange(at, min(at + QUERIES_AT_ONCE, len(prints)))
        node = leaf_of_top[node_of[query]]
        level = levels[-1]
        known = level["mask"][node]
        apart = np.bitwise_count((prints[query] ^ level["pattern"][node]) & known)
        for depth in range(len(levels) - 1, -1, -1):
            keep = apart <= distance
            query, node, apart = query[keep], node[keep], apart[keep]
            begin, n = levels[depth]["lead"][node], (levels[depth]["end"] - levels[depth]["lead"])[node]
            child = np.repeat(begin - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            query, apart, seen = np.repeat(query, n), np.repeat(apart, n), np.repeat(levels[depth]["mask"][node], n)
            mask, pattern = (levels[depth - 1]["mask"][child], levels[depth - 1]["pattern"][child]) if depth else (np.uint64(0xFFFFFFFFFFFFFFFF), prints[child])
            apart = apart + np.bitwise_count((prints[query] ^ pattern) & mask & ~seen)
            node = child
        found = (apart <= distance) & (query < node)
        yield query[found], node[found]


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index connected with each of `n` by the pairs."""
    root = np.arange(n)
    for a, b in pairs:
        while len(a):
            a, b = root[a], root[b]
            a, b = np.minimum(a, b), np.maximum(a, b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(root, b, a)
            while True:
                nearer = root[root]
                if np.array_equal(nearer, root):
                    break
                root = nearer
    return root


def _node_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) from each fingerprint of a node to the first one that it is connected with there."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(node: np.ndarray, pattern: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        first = np.r_[True, (node[1:] != node[:-1]) | (pattern[1:] != pattern[:-1])]
        alone = first & np.r_[first[1:], True]
        prints, first = prints[~alone], first[~alone]
        root = _roots(len(prints), links(prints.view(np.uint64), first))
        moved = root != np.arange(len(root))
        return pa.RecordBatch.from_arrays([pa.array(prints[moved]), pa.array(prints[root[moved]])], schema=schema)

    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
        rows += batch.num_rows
        if rows >= ROWS_AT_ONCE:
            node, pattern, prints = (np.concatenate(x) for x in zip(*held))
            last = np.flatnonzero((node[1:] != node[:-1]) | (pattern[1:] != pattern[:-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield edges(node[:cut], pattern[:cut], prints[:cut])
            held, rows = [(node[cut:], pattern[cut:], prints[cut:])], len(node) - cut
    if rows:
        yield edges(*(np.concatenate(x) for x in zip(*held)))


def upper_nodes(prints: DataFrame, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(node, pattern, print): each distinct fingerprint under the upper nodes that hold it."""
    masks = child_masks(0)
    rows = _under(prints, masks)
    parts = []
    numbered = {i: mask for i, mask in enumerate(masks)}
    for _ in range(2):
        counts = rows.groupBy("node", "pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node_limit).select("node", "pattern")
        large = written(counts, "large-nodes")
        if large.isEmpty():
            break
        parts.append(rows.join(large, ["node", "pattern"], "left_anti"))
        refined, deeper = rows.join(large, ["node", "pattern"], "left_semi"), {}
        pieces = []
        for number, mask in numbered.items():
            children = {len(numbered) * (len(deeper) + 100) + i: m for i, m in enumerate(child_masks(mask))}
            deeper |= children
            pieces += [(number, child, m) for child, m in children.items()]
        wanted = F.array(*(F.struct(F.lit(n).alias("of"), F.lit(c).alias("node"), F.lit(_signed(m)).alias("mask")) for n, c, m in pieces))
        children = F.explode(F.filter(wanted, lambda x: x["of"] == F.col("node")))
        rows = written(
            refined.select("print", children.alias("child")).select(F.col("child.node").alias("node"), F.col("print").bitwiseAND(F.col("child.mask")).alias("pattern"), "print"),
            "refined-nodes",
        )
        numbered = deeper
    parts.append(rows)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _under(prints: DataFrame, masks: list[int]) -> DataFrame:
    nodes = F.explode(F.array(*(F.struct(F.lit(i).alias("node"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("pattern")) for i, m in enumerate(masks))))
    return prints.select("print", nodes.alias("at")).select("at.node", "at.pattern", "print")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", node_limit: int = NODE_LIMIT) -> DataFrame:
    """(key, fingerprint, component_id, root) of every row.

    Rows whose fingerprints differ in two bits at most are linked; component_id is the smallest key
    reachable (null where the component has none but null keys), root a fingerprint of the component that all
    of its rows share. Null texts, empty ones and texts of white space have fingerprint zero and are linked
    like any other. Equal rows come back as often as they were there. Copies fall together before the search, so
    a group of copies of any size costs one fingerprint. Other columns are not looked at.
    """
    rows = written(fingerprints(docs, key, text), "prints")
    smallest = rows.groupBy("print").agg(F.min("key").alias("smallest"))
    distinct = written(smallest, "distinct-prints")
    placed = upper_nodes(distinct.select("print"), node_limit)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rank = F.col("print")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    sorted_nodes = placed.withColumn("rank", rank).repartition(width, "node", "pattern").sortWithinPartitions("node", "pattern", "rank").select("node", "pattern", "print")
    edges = sorted_nodes.mapInArrow(_node_edges, "a long, b long")
    roots = components(edges)
    return named_rows(rows, distinct, roots, key)


def named_rows(rows: DataFrame, distinct: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """(key, fingerprint, component_id, root) of `rows` (key, print), given the smallest key of each print and the roots of linked ones."""
    rooted = distinct.join(roots, distinct.print == roots.node, "left").select("print", "smallest", F.coalesce("root", "print").alias("root"))
    rooted = written(rooted, "rooted")
    reach = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = written(rooted.join(reach, "root").select(F.col("print").alias("named"), "root", "component_id"), "named-prints")
    joined = rows.join(named, rows.print == named.named, "left")
    return joined.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", F.lower(F.lpad(F.hex("root"), 16, "0")).alias("root"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", node_limit: int = NODE_LIMIT) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest key stays.

    Of several rows with that key, and of components that have none but null keys, the row with the
    smallest text stays. Columns are those of `docs`.
    """
    found = written(near_duplicates(docs, key, text, node_limit), "near-duplicates")
    return keep_smallest(docs, found, key, text)


def keep_smallest(docs: DataFrame, found: DataFrame, key: str, text: str, print_of: Callable[[bytes], int] = fingerprint) -> DataFrame:
    """The rows of `docs` that `near_duplicates` names as the smallest of their component; its fingerprints are made by `print_of`.

    Only keys move: those of rows to be left out, and those that several rows share, which are settled apart.
    """
    leads = F.coalesce(F.col(key) == F.col("component_id"), F.lit(False))
    by_key = found.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"), F.max(leads).alias("__leads"))
    gone = written(by_key.where("__rows > 1 or not __leads").select("__key", "__leads"), "left-out")
    kept = docs.where(F.col(key).isNotNull()).join(gone, docs[key] == F.col("__key"), "left_anti")
    shared = docs.join(gone.where("__leads"), docs[key] == F.col("__key"), "left_semi")
    rank = F.struct(*(F.col(f"`{c}`") for c in [text, *(c for c in docs.columns if c != text)]))
    chosen = shared.groupBy(F.col(key).alias("__key")).agg(F.min(rank).alias("__row")).select(*(F.col(f"__row.`{c}`").alias(c) for c in docs.columns))
    kept = kept.unionByName(chosen)
    unnamed = found.where(F.col("component_id").isNull())
    if unnamed.isEmpty():
        return kept
    roots = unnamed.select(F.col("fingerprint").alias("__print"), F.col("root").alias("__root")).distinct()
    lost = fingerprints_of_unnamed(docs, key, text, print_of).join(roots, "__print")
    first = lost.groupBy("__root").agg(F.min(rank).alias("__row")).select(*(F.col(f"__row.`{c}`").alias(c) for c in docs.columns))
    return kept.unionByName(first)


def fingerprints_of_unnamed(docs: DataFrame, key: str, text: str, print_of: Callable[[bytes], int] = fingerprint) -> DataFrame:
    """The rows with a null key and their fingerprints."""
    unnamed = docs.where(F.col(key).isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = [b"" if t is None else t.encode() for t in batch.column(at).to_pylist()]
            yield batch.append_column("__print", pa.array([f"{print_of(t):016x}" for t in texts]))

    return unnamed.mapInArrow(run, StructType([*unnamed.schema.fields, StructField("__print", StringType())]))
