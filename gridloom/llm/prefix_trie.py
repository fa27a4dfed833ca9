"""Prefix trie of conversations from padded matrices of turn ids.

A turn's id is a 128-bit hash of its role and text, so that texts are left behind before anything moves. Conversations are
dealt over range shards in the order of their ids, ties by key. A shard sorts its conversations by numpy's lexsort on
a padded matrix of ids, a block of columns at a time: only conversations that are longer go on to the next block, so the
matrix grows with the turns, not with the longest conversation. In sorted order a node begins where any column up to its
depth changes; the changes of the columns are accumulated by OR, and reduceat over the starts gives the sums of
every node of a depth.

Nodes of one depth lie in the order of their shards, so only those that hold the first or the last conversation of a shard can
reach into another one. These boundary nodes leave the shard as partial sums, named by a hash of their prefix. They are
summed by name; leaves and savings of their subtrees are summed over the chain of nodes above each of them. All other nodes
are complete in their shard, but for the name of a parent on the boundary, which the shard gets back by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import written
from gridloom.session import shuffle_width

#: Conversations of a shard, columns of a matrix, and ids in a block that leaves a shard.
ROWS_PER_SHARD = 50_000
COLUMNS_AT_ONCE = 8
IDS_PER_BLOCK = 8192
NOTHING = hashlib.sha256(b"").hexdigest()
TURNS = "array<struct<a: bigint, b: bigint, n: int>>"


def turn_sequences(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turns): the turns of each conversation in order, as (a, b, n): two hashes of role and text, code points of the text.

    A null turn comes first, a null role or text is empty. Turns with the same number, repeated rows among them,
    stand in the order of their hashes. Rows without a key are left out: a tree names its nodes by
    keys. A conversation is one row, of 28 bytes a turn.
    """
    said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    one = F.struct(F.col(turn).alias("turn"), F.xxhash64(*said).alias("a"), F.xxhash64(F.lit(1), *said).alias("b"), F.length(said[1]).alias("n"))
    gathered = turns.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias(key)).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    return gathered.select(key, F.transform("turns", lambda t: F.struct(t["a"], t["b"], t["n"])).cast(TURNS).alias("turns"))


def with_shared_openings(sequences: DataFrame, key: str = "conv_id", every: int = 100, most: int = 6) -> DataFrame:
    """Conversations whose first h turns are those of conversation c - c % `every`, h = crc32(decimal c) % `most`.

    If that one is shorter, all of its turns; if it is absent, none. Then follow the conversation's own turns after its first h.
    """
    h = (F.crc32(F.col(key).cast("string").cast("binary")) % most).cast("int")
    openings = sequences.where(F.col(key) % every == 0).select(F.col(key).alias("__opener"), F.slice("turns", 1, most - 1).alias("__opening"))
    met = sequences.withColumn("__opener", F.col(key) - F.col(key) % every).join(openings, "__opener", "left")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    shared = F.slice(F.coalesce("__opening", F.array().cast(TURNS)), F.lit(1), h)
    return met.select(key, F.concat(shared, own).alias("turns"))


@dataclass
class Level:
    """The nodes of one depth, in order: what reduceat gives, then what their children add."""

    n_convs: np.ndarray
    smallest: np.ndarray
    size: np.ndarray
    parent: np.ndarray
    row: np.ndarray
    ends: list[np.ndarray] = field(default_factory=list)
    n_children: np.ndarray | None = None
    n_leaves: np.ndarray | None = None
    saved: np.ndarray | None = None


def levels(keys: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> list[Level]:
    """The trie of a shard, a level per depth; row i has the turns offsets[i] to offsets[i + 1] of a, b and n."""
    length = np.diff(offsets)
    rows = np.lexsort((keys,))
    node = np.zeros(len(rows), np.int64)  # of each of `rows`, at the present depth
    out = [Level(np.array([len(rows)]), np.array([keys.min()]), np.zeros(1, np.int64), np.zeros(1, np.int64), rows[:1])]
    depth = 0
    while len(rows):
        width = COLUMNS_AT_ONCE
        ended = length[rows] == depth
        out[-1].ends = _by_node(node[ended], keys[rows[ended]], len(out[-1].n_convs))
        rows, node = rows[~ended], node[~ended]
        if not len(rows):
            break
        at = offsets[rows][:, None] + depth + np.arange(width)
        there = at < offsets[rows + 1][:, None]
        at = np.where(there, at, 0)
        low = np.iinfo(np.int64).min
        ids = np.stack([np.where(there, a[at], low), np.where(there, b[at], low), there], 2).reshape(len(rows), -1)
        order = np.lexsort((keys[rows], *ids.T[::-1], node))
        rows, node, ids, there, at = rows[order], node[order], ids[order], there[order], at[order]
        changed = np.r_[True, node[1:] != node[:-1]]
        for column in range(width):
            depth += 1
            part = ids[:, 3 * column : 3 * column + 3]
            changed[1:] |= (part[1:] != part[:-1]).any(1)  # a node begins where a column up to its own changes
            live = np.flatnonzero(there[:, column])
            if not len(live):
                break
            # Rows that have ended sort before the others under their node, so the live rows of a node are together.
            starts = np.flatnonzero(changed[live])
            number = np.cumsum(changed[live]) - 1
            first = live[starts]
            out.append(Level(np.diff(np.r_[starts, len(live)]), np.minimum.reduceat(keys[rows[live]], starts), n[at[first, column]].astype(np.int64), node[first], rows[first]))
            node[live] = number
            if column + 1 < width:
                done = np.flatnonzero(length[rows] == depth)
                out[-1].ends = _by_node(node[done], keys[rows[done]], len(starts))
        else:
            live = np.flatnonzero(there[:, -1])
            rows, node = rows[live], node[live]
            continue
        break
    _subtrees(out)
    return out


def _by_node(node: np.ndarray, keys: np.ndarray, nodes: int) -> list[np.ndarray]:
    order = np.lexsort((keys, node))
    return np.split(keys[order], np.searchsorted(node[order], np.arange(1, nodes)))


def _subtrees(tree: list[Level]) -> None:
    below: Level | None = None
    for level in reversed(tree):
        nodes = len(level.n_convs)
        own = (level.n_convs - 1) * level.size
        if below is None:
            level.n_children, level.n_leaves, level.saved = np.zeros(nodes, np.int64), np.ones(nodes, np.int64), own
        else:
            level.n_children = np.bincount(below.parent, minlength=nodes)
            level.n_leaves, level.saved = (level.n_children == 0).astype(np.int64), own.copy()
            np.add.at(level.n_leaves, below.parent, below.n_leaves)
            np.add.at(level.saved, below.parent, below.saved)
        if not level.ends:
            level.ends = [np.empty(0, np.int64)] * nodes
        below = level


def edge_path(tree: list[Level], last: bool) -> list[int]:
    """The nodes that hold the first, or the last, conversation of the shard, from the root down."""
    path = [0]
    while True:
        depth, at = len(path) - 1, path[-1]
        if not tree[depth].n_children[at] or (not last and len(tree[depth].ends[at])):
            return path
        children = np.flatnonzero(tree[depth + 1].parent == at)
        path.append(int(children[-1 if last else 0]))


def ends_digest(keys: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, keys.tolist())).encode()).hexdigest() if len(keys) else NOTHING


NODE = {
    "kind": pa.string(), "shard": pa.int64(), "depth": pa.int64(), "name": pa.binary(), "above": pa.binary(), "chain": pa.list_(pa.binary()),
    "smallest": pa.int64(), "parent": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved": pa.int64(),
    "size": pa.int64(), "digest": pa.string(), "ids": pa.binary(),
}
NODE_TYPES = (
    "kind string, shard long, depth long, name binary, above binary, chain array<binary>, smallest long, parent long, "
    "n_convs long, n_children long, n_leaves long, saved long, size long, digest string, ids binary"
)
NODE_ARROW = pa.schema(list(NODE.items()))


def _shard_rows(shard: int, tree: list[Level], prefix_of) -> Iterator[pa.RecordBatch]:
    """What leaves a shard: `whole` nodes, `edge` nodes with what their whole children add, and the `ends` of edge nodes.

    `prefix_of(row, depth)` are the bytes of the first turns of a row.
    """
    on_edge: list[dict[int, bytes]] = [{} for _ in tree]
    for path in (edge_path(tree, False), edge_path(tree, True)):
        for depth, at in enumerate(path):
            on_edge[depth][at] = hashlib.blake2b(prefix_of(int(tree[depth].row[at]), depth), digest_size=16).digest()
    edges, chains = [], {}
    for depth, level in enumerate(tree):
        at = np.array(sorted(on_edge[depth]), np.int64)
        whole = np.ones(len(level.n_convs), bool)
        whole[at] = False
        for one in at.tolist():
            name, above = on_edge[depth][one], on_edge[depth - 1][int(level.parent[one])] if depth else None
            chain = [*chains[above], above] if above is not None else []
            chains[name] = chain
            children = leaves = saved = 0
            if depth + 1 < len(tree):
                own = np.flatnonzero(tree[depth + 1].parent == one)
                own = own[[int(c) not in on_edge[depth + 1] for c in own]] if len(own) else own
                children, leaves, saved = len(own), int(tree[depth + 1].n_leaves[own].sum()), int(tree[depth + 1].saved[own].sum())
            common = {"shard": shard, "depth": depth, "name": name}
            edges.append(common | {"kind": "edge", "above": above, "chain": chain, "smallest": int(level.smallest[one]), "n_convs": int(level.n_convs[one]), "n_children": children, "n_leaves": leaves, "saved": saved, "size": int(level.size[one])})
            ids = level.ends[one]
            for begin in range(0, len(ids), IDS_PER_BLOCK):
                part = ids[begin : begin + IDS_PER_BLOCK]
                edges.append(common | {"kind": "ends", "smallest": int(part[0]), "ids": part.astype("<i8").tobytes()})
        inside = np.flatnonzero(whole)
        if len(inside):
            parent = level.parent[inside]
            named = on_edge[depth - 1]
            columns = {
                "kind": ["whole"] * len(inside), "shard": np.full(len(inside), shard), "depth": np.full(len(inside), depth),
                "above": [named.get(p) for p in parent.tolist()], "smallest": level.smallest[inside], "parent": tree[depth - 1].smallest[parent],
                "n_convs": level.n_convs[inside], "n_children": level.n_children[inside], "n_leaves": level.n_leaves[inside], "saved": level.saved[inside],
                "digest": [ends_digest(level.ends[i]) for i in inside.tolist()],
            }
            yield pa.RecordBatch.from_arrays([pa.array(columns[c], kind) if c in columns else pa.nulls(len(inside), kind) for c, kind in NODE.items()], schema=NODE_ARROW)
    yield pa.RecordBatch.from_pylist(edges, schema=NODE_ARROW)


def _sharded(sequences: DataFrame, key: str) -> DataFrame:
    """The rows that leave the shards."""
    spark = sequences.sparkSession
    stored = written(sequences.select(F.col(key).alias("key"), "turns"), "conversations")
    shards = max(shuffle_width(spark), -(-stored.count() // ROWS_PER_SHARD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        turns = rows.column("turns").combine_chunks()
        turns = turns.chunk(0) if isinstance(turns, pa.ChunkedArray) else turns
        offsets = turns.offsets.to_numpy().astype(np.int64)
        a, b, n = (turns.values.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "n"))
        keys = rows.column("key").to_numpy()
        tree = levels(keys, offsets, a, b, n)

        def prefix_of(row: int, depth: int) -> bytes:
            at = slice(offsets[row], offsets[row] + depth)
            return np.stack([a[at], b[at]], 1).astype("<i8").tobytes()

        yield from _shard_rows(TaskContext.get().partitionId(), tree, prefix_of)

    return stored.repartitionByRange(shards, "turns", "key").mapInArrow(run, NODE_TYPES)


def _stream_digests(blocks: DataFrame) -> DataFrame:
    """(name, digest) of the ids in all blocks of each node, in order.

    SHA-256 goes over a node's ids in one go, so they pass through one task, as a stream of blocks that is never held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, hashlib.sha256()
        for batch in batches:
            names, digests = [], []
            for own, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ",".join(map(str, np.frombuffer(raw.as_py(), "<i8").tolist())).encode()
                if own != name:
                    if name is not None:
                        names.append(name)
                        digests.append(digest.hexdigest())
                    name, digest = own, hashlib.sha256(ids)
                else:
                    digest.update(b"," + ids)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], ["name", "digest"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()])], ["name", "digest"])

    ordered = blocks.repartition(shuffle_width(blocks.sparkSession), "name").sortWithinPartitions("name", "smallest")
    return ordered.select("name", "ids").mapInArrow(run, "name binary, digest string")


def prefix_trie(sequences: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per distinct prefix of the `turns` of `sequences` (key, turns), the root among them.

    key: the smallest member; depth; parent_<key>: the parent's smallest member, null for the root; n_convs: members; n_children;
    n_leaves: nodes without children in the subtree; saved_tokens: the sum over the subtree of (n_convs - 1) times the
    code points of the last turn; ends_sha256: of the decimal keys of the members that end here, ascending, with commas.
    Keys are whole numbers, distinct and not null, as `turn_sequences` gives them. A conversation without turns is a
    member of the root. No conversations, no nodes.
    """
    rows = written(_sharded(sequences, key), "trie-parts")
    parts = rows.where("kind = 'edge'")
    summed = parts.groupBy("name").agg(
        F.first("depth").alias("depth"), F.first("above").alias("above"), F.first("chain").alias("chain"), F.min("smallest").alias("smallest"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"), F.first("size").alias("size"),
    )
    summed = written(summed, "trie-edges")
    children = summed.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("name")).agg(F.count(F.lit(1)).alias("edge_children"))
    edges = summed.join(children, "name", "left").withColumn("n_children", F.col("inner_children") + F.coalesce("edge_children", F.lit(0)))
    edges = edges.withColumn("leaves", F.col("leaves") + (F.col("n_children") == 0).cast("long")).withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("size"))
    edges = written(edges, "trie-edges")
    over = edges.select(F.explode(F.concat("chain", F.array("name"))).alias("name"), "leaves", "saved").groupBy("name").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    digests = _stream_digests(rows.where("kind = 'ends'").select("name", "smallest", "ids"))
    above = edges.select(F.col("name").alias("above"), F.col("smallest").alias("above_smallest"))
    parent = f"parent_{key}"
    on_edge = (
        edges.drop("n_leaves").join(over, "name").join(digests, "name", "left").join(above, "above", "left")
        .select(F.col("smallest").alias(key), "depth", F.col("above_smallest").alias(parent), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("digest", F.lit(NOTHING)).alias("ends_sha256"))
    )
    shard_above = parts.select("shard", F.col("name").alias("above")).join(above, "above")
    inside = (
        rows.where("kind = 'whole'").join(shard_above, ["shard", "above"], "left")
        .select(F.col("smallest").alias(key), "depth", F.coalesce("above_smallest", "parent").alias(parent), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("digest").alias("ends_sha256"))
    )
    return on_edge.unionByName(inside)


def shared_opening_trie(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """The trie of the conversations of a table of turns after `with_shared_openings`."""
    return prefix_trie(with_shared_openings(turn_sequences(turns, key), key), key)
