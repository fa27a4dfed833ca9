"""SimHash groups against all pairs, and the index against a plain scan."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import simhash
from gridloom.llm.graph import components
from gridloom.llm.queries import QUERIES
from tests.llm.conftest import CLASHING, EDGES


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    label = [i if i is not None else float("inf") for i in ids]
    prints = np.array(prints, np.uint64)
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= 2) for p in prints]
    while True:
        new = [min(label[j] for j in n) for n in near]
        if new == label:
            return [None if x == float("inf") else x for x in label]
        label = new


def test_query_equals_all_pairs(spark, sf_dir, documents):
    got = QUERIES["op1_simhash"](spark, sf_dir).toPandas().sort_values("doc_id")
    docs = documents.sort_values("doc_id")
    prints = [plain_fingerprint(t) for t in docs.text]
    assert got.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    assert got.component_id.tolist() == plain_components(docs.doc_id.tolist(), prints)


def test_edges(spark, edge_docs, no_docs):
    got = simhash.near_duplicates(edge_docs).collect()
    assert len(got) == len(EDGES)
    prints = [plain_fingerprint(t) for _, t in EDGES]
    want = sorted(zip([i for i, _ in EDGES], [f"{p:016x}" for p in prints], plain_components([i for i, _ in EDGES], prints)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_component_stays(edge_docs, no_docs):
    kept = simhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.select("doc_id", "text").collect() if r.doc_id != 10 and r.doc_id not in (8, 9)) == [
        (0, "a row without an id"),
        (1, None),
        (4, "one"),
        (5, "one two three four five six seven eight nine ten"),
        (7, EDGES[7][1]),
    ]
    assert simhash.one_of_each(no_docs).count() == 0


def random_prints(n, seed=3):
    """Clusters of close fingerprints, chains of them, and strangers."""
    draw = np.random.default_rng(seed)
    out = [int(draw.integers(0, 2**63)) for _ in range(n // 4)]
    while len(out) < n:
        start = out[int(draw.integers(0, len(out)))]
        for b in draw.integers(0, 64, int(draw.integers(1, 4))):
            start ^= 1 << int(b)
        out.append(start)
    return out


def test_refined_index_finds_the_same_groups(spark):
    prints = random_prints(1500) + [1 << i | 1 << j for i in range(30) for j in range(i)]
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in set(prints)], "print long").withColumn("print", F.col("print"))
    unique = sorted(set(prints))
    want = plain_components(list(range(len(unique))), unique)
    for limit in (2, 40, 10**6):
        placed = simhash.upper_nodes(frame, limit)
        rank = placed.repartition(4, "node", "pattern").sortWithinPartitions("node", "pattern", "print").select("node", "pattern", "print")
        roots = {r.node: r.root for r in components(rank.mapInArrow(simhash._node_edges, "a long, b long")).collect()}
        signed = [p - (1 << 64) if p >> 63 else p for p in unique]
        group = [roots.get(s, s) for s in signed]
        first = {}
        got = [first.setdefault(g, i) for i, g in enumerate(group)]
        assert got == want, limit


def test_tree_search_equals_a_scan():
    prints = np.array(sorted(set(random_prints(800)), key=lambda p: int(simhash.gray_rank(np.array([p], np.uint64))[0])), np.uint64)
    first = np.r_[True, np.zeros(len(prints) - 1, bool)]
    found = {(int(a), int(b)) for x, y in simhash.links(prints, first) for a, b in zip(x, y)}
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    assert found == {(int(a), int(b)) for a, b in zip(*np.nonzero(apart <= 2)) if a < b}


def test_gray_neighbours_differ_in_one_bit():
    code = np.arange(1 << 10, dtype=np.uint64)
    gray = code ^ code >> np.uint64(1)
    assert (simhash.gray_rank(gray) == code).all()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (1, 0)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({roots[i] for i in range(301)}) == 1
    assert len({roots[1000 + i] for i in range(200)}) == 1
    assert roots[0] != roots[1000] and 5000 not in roots
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_clashing_names_are_there(edge_docs):
    assert set(CLASHING) - {"url"} <= set(edge_docs.columns)


def test_pipeline_keeps_the_first_of_each_component(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = documents.doc_id.tolist()
    want = set(plain_components(ids, [plain_fingerprint(t) for t in documents.text]))
    kept = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert len(want) < len(ids)
