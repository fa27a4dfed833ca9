"""Token files, packing, the language model and the pipeline against plain versions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gridloom.llm import attention, language_model, packing, pii, repetition, token_files, tokens
from gridloom.llm.queries import QUERIES
from tests.llm.conftest import EDGES
from tests.llm.test_near_dedup import plain_components, plain_fingerprint
from tests.llm.test_text_stages import plain_measures


def library_ids(texts):
    tool = Tokenizer.from_file(tokens.default_path())
    return [e.ids + [1] for e in tool.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_cached_words_give_the_library_ids():
    texts = ["", None, "a's b'll 'S !'s x'", "<|endoftext|> a<|startoftext|>b", "É'S L'ÉTÉ'D ½ ª", "a\x85b\xa0c", "İ ΣΑΣ ﬁ 中文", "x" * 4000, *(t for _, t in EDGES)]
    assert [x.tolist() for x in tokens.encoded(texts, tokens.default_path())] == library_ids(texts)


def test_coding_round_trip():
    values = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, *range(1000)], np.uint64).astype(np.uint32)
    for n in (0, 1, 2, 3, 4, 5, len(values)):
        control, data = token_files.pack(values[:n])
        assert token_files.unpack(control, data, n).tolist() == values[:n].tolist()
        assert len(control) == -(-n // 4)


def test_token_file_query_equals_the_library(spark, sf_dir, documents):
    got = QUERIES["op3_token_files"](spark, sf_dir).toPandas().sort_values("doc_id")
    docs = documents.sort_values("doc_id")
    ids = library_ids(docs.text)
    sizes = [len(x) for x in ids]
    assert got.n_tokens.tolist() == sizes
    assert got.start.tolist() == np.cumsum([0, *sizes[:-1]]).tolist()
    assert got.ids_crc32.tolist() == [crc(x) for x in ids]


def test_token_files_of_edges(spark, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(token_files, "IDS_PER_BLOCK", 50)
    from gridloom.session import fresh_path

    folder = fresh_path(spark, "token-test")
    token_files.write_tokens(edge_docs, folder, ids_per_file=2000)
    got = token_files.document_digests(spark, folder).collect()
    want = Counter((i, len(x), crc(x)) for (i, _), x in zip(EDGES, library_ids([t for _, t in EDGES])))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == np.cumsum([0, *(r.n_tokens for r in order[:-1])]).tolist()
    keys = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert keys == sorted(keys)
    assert token_files.round_trip(no_docs).count() == 0


def check_pieces(got, ids, limits):
    by_doc = got.groupby("doc_id", dropna=False)
    for doc_id, rows in by_doc:
        rows = rows.sort_values("start")
        whole = ids[doc_id]
        assert rows.start.tolist() == np.cumsum([0, *rows.length.tolist()[:-1]]).tolist() and rows.length.sum() == len(whole)
        assert all(crc(whole[r.start : r.start + r.length]) == r.ids_crc32 and r.doc_tokens == len(whole) for r in rows.itertuples())
    for _, rows in got.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == np.cumsum([0, *rows.length.tolist()[:-1]]).tolist()
        assert rows.length.sum() <= limits.tokens and len(rows) <= limits.segments


def test_packing_query(spark, sf_dir, documents):
    got = QUERIES["op4_packing"](spark, sf_dir).toPandas()
    ids = dict(zip(documents.doc_id, library_ids(documents.text)))
    check_pieces(got, ids, packing.Limits())
    total = sum(map(len, ids.values()))
    assert set(got.doc_id) == set(ids)
    assert 2048 * got.sequence_id.nunique() - total <= 2048 + 0.01 * total


def test_packing_edges(edge_docs, no_docs):
    got = packing.packed_documents(edge_docs)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = got.toPandas()
    assert rows.length.sum() == sum(map(len, library_ids([t for _, t in EDGES])))
    assert packing.packed_documents(no_docs).count() == 0


def test_all_three_limits_hold_and_the_heuristic_fills():
    draw = np.random.default_rng(4)
    limits = packing.Limits(tokens=256, segments=5, loss=100, least_piece=4)
    packer, out, total = packing.Packer(limits), [], 0
    for i in range(400):
        n = int(draw.integers(1, 300))
        loss = draw.random(n) < draw.random()
        out += packer.add(packing.Piece(i, 0, np.arange(n), n, loss))
        total += n
    out += packer.sequences(True)
    for sequence in out:
        assert sum(len(p.ids) for p in sequence) <= 256 and len(sequence) <= 5
        assert sum(int(p.loss.sum()) for p in sequence) <= 100
    assert sum(len(p.ids) for s in out for p in s) == total
    seen = Counter((p.doc, int(i)) for s in out for p in s for i in p.ids)
    assert max(seen.values()) == 1
    assert len(out) <= 1.3 * max(total / 256, sum(int(p.loss.sum()) for s in out for p in s) / 100)


def test_conversations_respect_loss(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = packing.packed_conversations(turns).toPandas()
    assert set(got.conv_id) == {r.conv_id for r in turns.select("conv_id").distinct().collect()}
    sizes = got.groupby("sequence_id").length.agg(["sum", "size"])
    assert sizes["sum"].max() <= 2048 and sizes["size"].max() <= 32


# --- language model -----------------------------------------------------------------------------


def tiny_model(n=40):
    counts = np.arange(n, dtype=float) ** 1.5
    return attention.Model(counts, attention.Shape(width=8, context=4, stride=4, own_rows=n, shared_rows=2, choices=20, upper=6, upper_levels=3, lower_levels=4))


def test_probabilities_sum_to_one_after_every_context():
    model = tiny_model()
    draw = np.random.default_rng(0)
    for name in model.TABLES[:6]:
        model.p[name] = model.p[name] + draw.standard_normal(model.p[name].shape).astype(np.float32) * 0.3
    model.p["choice"][6] = 0
    n = 40
    context = [39, 3, 5, 8, 2, 7, 7]
    rows = np.array([[*context, t] for t in range(n - 1)]).reshape(-1)
    ends = np.arange(1, n) * 8
    some = model.log_probabilities(rows, ends)[6::8]
    only = model.log_probabilities(np.array(context), np.array([7]))[-1]
    assert np.exp(some).sum() + np.exp(only) == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("power", [1.0, 1.5, 3.0])
def test_probabilities_of_the_production_shape_sum_to_one_on_skewed_counts(power):
    n = 3000
    model = attention.Model(1e8 / np.arange(1.0, n + 1) ** power)
    draw = np.random.default_rng(4)
    model.p["choice"] = draw.standard_normal(model.p["choice"].shape).astype(np.float32)
    model.p["choice"][model.shape.upper] = 0
    rows = np.array([[n - 1, 2, 5, t] for t in range(n - 1)]).reshape(-1)
    some = model.log_probabilities(rows, np.arange(1, n) * 4)[2::4]
    only = model.log_probabilities(np.array([n - 1, 2, 5]), np.array([3]))[-1]
    assert np.exp(some.astype(float)).sum() + np.exp(float(only)) == pytest.approx(1, abs=1e-3)


def test_untrained_model_is_the_unigram_model():
    model = tiny_model()
    counts = np.arange(40.0) ** 1.5 + 0.5
    got = model.log_probabilities(np.array([39, 1, 2, 3]), np.array([4]))
    assert np.allclose(got, np.log(counts / counts.sum())[[1, 2, 3, 39]], atol=1e-4)


def test_attention_is_causal_and_windows_score_each_id_once():
    model = tiny_model()
    draw = np.random.default_rng(1)
    for name in model.TABLES[:4]:
        model.p[name] = model.p[name] + draw.standard_normal(model.p[name].shape).astype(np.float32)
    model.p["choice"] = draw.standard_normal(model.p["choice"].shape).astype(np.float32)
    model.p["choice"][6] = 0
    ids = np.r_[39, draw.integers(0, 39, 30)]
    whole = model.log_probabilities(ids, np.array([31]))
    changed = ids.copy()
    changed[20:] = 5
    assert np.allclose(model.log_probabilities(changed, np.array([31]))[:19], whole[:19])
    two = model.log_probabilities(np.r_[ids, ids], np.array([31, 62]))
    assert np.allclose(two, np.r_[whole, whole], atol=1e-5)
    first, text = model.windows(np.r_[ids, ids], np.array([31, 62]))
    assert first.tolist() == [*range(0, 31, 4), *range(31, 62, 4)] and text.tolist() == [0] * 8 + [1] * 8


def test_each_id_sees_at_least_sixty_four_before_it():
    model = attention.Model(np.arange(100.0))
    draw = np.random.default_rng(6)
    model.p["choice"] = draw.standard_normal(model.p["choice"].shape).astype(np.float32)
    ids = np.r_[99, draw.integers(0, 99, 200)]
    whole, changed = model.log_probabilities(ids, np.array([201])), ids.copy()
    changed[60] = (ids[60] + 1) % 99
    moved = np.abs(model.log_probabilities(changed, np.array([201])) - whole) > 0
    assert moved[61:125].mean() > 0.9 and not moved[:59].any()


def test_gradients_raise_the_likelihood_of_held_out_text():
    draw = np.random.default_rng(2)

    def text():  # every second id tells the next one
        first = draw.integers(0, 8, 60)
        return np.stack([first, first + 10], 1).reshape(-1)

    model = tiny_model()
    rows, ends = attention.rows_of_texts((text() for _ in range(60)), 39)
    held, held_ends = attention.rows_of_texts((text() for _ in range(10)), 39)
    before = model.log_probabilities(held, held_ends).mean()
    memory = model.memory()
    for _ in range(4):
        model.train(rows, ends, np.arange(len(model.windows(rows, ends)[0])), memory)
    assert model.log_probabilities(held, held_ends).mean() > before + 0.8


def window_texts():
    draw = np.random.default_rng(8)
    return attention.rows_of_texts((draw.integers(0, 39, n) for n in (90, 0, 3, 4, 61)), 39)


@pytest.mark.parametrize("together", [1, 3, 1000])
def test_windows_made_together_change_no_result(monkeypatch, together):
    """Only a few windows' attention is held at a time; neither a step nor a score depends on how many."""
    rows, ends = window_texts()
    got = []
    for number in (attention.WINDOWS_AT_ONCE, together):
        monkeypatch.setattr(attention, "WINDOWS_AT_ONCE", number)
        model = tiny_model()
        memory = model.memory()
        for _ in range(2):
            model.train(rows, ends, np.arange(len(model.windows(rows, ends)[0])), memory, at_once=11)
        got.append((model.flat(), model.log_probabilities(rows, ends, at_once=7)))
    for one, other in zip(*got):
        assert np.allclose(one, other, rtol=0, atol=1e-6)


def test_a_step_follows_the_gradient_of_every_table():
    """The first step on one window is the Adagrad step by the slopes of its log probability, taken by differences."""
    draw = np.random.default_rng(9)
    model = tiny_model()
    for name in model.TABLES[:6]:
        model.p[name] = model.p[name] + draw.standard_normal(model.p[name].shape).astype(np.float32) * 0.3
    model.p["choice"][6] = 0
    ids, ends = np.array([39, 38, 1, 2]), np.array([4])
    start = {name: value.copy() for name, value in model.p.items()}
    slopes = {}
    for name in ("last", "query", "key", "value", "near", "choice", "odds"):
        slopes[name] = np.zeros(start[name].shape)
        for place in np.ndindex(start[name].shape):
            ways = []
            for by in (0.01, -0.01):
                model.p[name][place] = start[name][place] + np.float32(by)
                ways.append(model.log_probabilities(ids, ends).astype(float).sum())
            model.p[name][place] = start[name][place]
            slopes[name][place] = (ways[0] - ways[1]) / 0.02
    memory = model.memory()
    model.train(ids, ends, np.array([0]), memory)
    for name, slope in slopes.items():
        rate = 0.08 * (0.3 if name in ("odds", "near") else 1)
        if name in ("choice", "odds"):  # free places
            slope[6] = 0
        want = rate * slope / np.sqrt(0.1 + slope**2 + 1e-6)
        assert np.allclose(model.p[name] - start[name], want, atol=1e-3), name


def test_steps_on_ids_without_lower_choices():
    """Places for lower choices that are free take no part in a step; there may be no others."""
    model = tiny_model(5)
    assert (model.tree.node[:, model.tree.upper_levels :] == model.shape.upper).all()
    rows, ends = np.r_[4, np.tile([0, 1], 8)], np.array([17])
    before, lower, memory = model.log_probabilities(rows, ends).sum(), model.p["choice"][model.shape.upper + 1 :].copy(), model.memory()
    for _ in range(3):
        model.train(rows, ends, np.arange(len(model.windows(rows, ends)[0])), memory)
    assert model.log_probabilities(rows, ends).sum() > before
    assert np.array_equal(model.p["choice"][model.shape.upper + 1 :], lower)


def plain_base(docs):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs]
    words = [[*(t or "").encode().lower().split(), b""] for _, t in docs]
    counts = Counter(w for row, h in zip(words, held) if not h for w in row)
    total = sum(counts.values())
    scale = total + 0.5 * (len(counts) + 1)
    return [(i, h, len(row), sum(w in counts for w in row), total, sum(math.log10((counts[w] + 0.5) / scale) for w in row)) for (i, _), h, row in zip(docs, held, words)]


def test_scores_query(spark, sf_dir, documents):
    got = QUERIES["op6_attention"](spark, sf_dir).toPandas().sort_values("doc_id")
    want = plain_base(sorted(zip(documents.doc_id, documents.text)))
    for row, (doc_id, held, n, known, total, base) in zip(got.itertuples(), want):
        assert (row.doc_id, row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (doc_id, held, n, known, total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert -60 * n < row.score < 0
    held = got[got.held_out]
    assert held.score.sum() / held.n_tokens.sum() > -7


def plain_score(model, ids, mark):
    """log10 probability of the ids and the end: each place attends to the places of its window one by one."""
    p, shape, tree = model.p, model.shape, model.tree
    text, total = [mark, *ids.tolist()], 0.0
    row = [int(model.row[i]) for i in text]
    for place in range(len(text)):
        first = max(0, place // shape.stride * shape.stride - shape.context)
        seen = range(first, place + 1)
        query = p["query"][row[place]].astype(float)
        weight = [math.exp(min(60.0, float(query @ p["key"][row[j]]) + float(p["near"][place - j]))) for j in seen]
        h = sum(w * p["value"][row[j]].astype(float) for w, j in zip(weight, seen)) / sum(weight) + p["last"][row[place]]
        h = h / (1 + abs(h))
        after = text[place + 1] if place + 1 < len(text) else mark
        total += float(tree.rest[after])
        for node, sign in zip(tree.node[after].tolist(), tree.sign[after].tolist()):
            total -= math.log1p(math.exp(-sign * (float(p["choice"][node] @ h) + float(p["odds"][node]))))
    return total / math.log(10)


def test_scores_equal_a_loop_over_places(spark, sf_dir, documents):
    path = language_model.default_path()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select(F.col("doc_id").alias("key"), language_model.is_held_out(F.col("doc_id")).alias("held"), language_model.as_bytes("text").alias("text"))
    stored = language_model.stored_ids(rows, path)
    model = language_model.trained(stored, path)
    dtype, mark = language_model.encoder(path).dtype, language_model.encoder(path).size
    want = {r.key: plain_score(model, np.frombuffer(r.ids, dtype), mark) for r in stored.collect() if len(r.ids) < 1500}
    got = {r.doc_id: r.score for r in QUERIES["op6_attention"](spark, sf_dir).collect()}
    assert len(want) > 0.4 * len(got) and np.abs(model.p["choice"]).max() > 0.1
    for key, score in want.items():
        assert got[key] == pytest.approx(score, rel=1e-4, abs=1e-3)


@pytest.mark.parametrize("most_frequent", [0, 3, 10**6])
def test_rare_words_are_looked_up(edge_docs, most_frequent):
    got = language_model.scored_documents(edge_docs, most_frequent=most_frequent).collect()
    want = plain_base(EDGES)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == Counter(x[:5] for x in want)
    assert sorted(round(r.base_score, 6) for r in got) == sorted(round(x[5], 6) for x in want)


def test_no_documents_to_score(no_docs):
    assert language_model.scored_documents(no_docs).count() == 0


def test_every_window_of_every_text_is_trained_once(spark, monkeypatch):
    """The rounds of a window are one and the same each time it is asked, and the steps taken are all windows."""
    model = tiny_model()
    rows, ends = attention.rows_of_texts((np.full(n, 3) for n in (0, 1, 5, 400)), 39)
    first, text = model.windows(rows, ends)
    sums = np.array([-5, 0, 7, 1 << 62])
    for rounds in (1, 2, 5):
        drawn = language_model.rounds_of_windows(sums, first, text, rounds)
        assert len(drawn) == len(first) == 1 + 1 + 2 + 101 and set(drawn) == set(range(rounds))
        taken = []
        monkeypatch.setattr(attention.Model, "_step", lambda self, rows, follow, first, begin, end, memory, rate: taken.extend(first.tolist()))
        for round_ in range(rounds):
            model.train(rows, ends, np.flatnonzero(drawn == round_), {})
        assert sorted(taken) == first.tolist()
        monkeypatch.undo()
    path = language_model.default_path()
    tool = language_model.encoder(path)
    for ids in tool.encode(["one", "other words", "third text"]):  # texts of one window each
        table = spark.createDataFrame([(len(ids) * 12345, False, bytearray(ids))], "sum long, held boolean, ids binary")
        assert np.abs(language_model.trained(table, path).p["choice"]).sum() > 0


# --- pipeline -----------------------------------------------------------------------------------


def plain_kept(text):
    n, _, _, _, window, covered, longest = plain_measures(text)
    rules = repetition.Rules()
    if n < rules.fewest_words or 100 * window > rules.window_percent * n or 100 * covered > rules.covered_percent * n:
        return False
    return longest <= max(rules.longest_words, n * rules.longest_percent // 100)


def plain_leaks(texts, items):
    """Which texts hold four fifths of the five-word shingles of an item."""
    words = lambda text: re.findall(r"[^\W_]+", (text or "").lower())
    sets = [{tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for w in map(words, items) if w for k in [min(5, len(w))]]
    for text in texts:
        w = words(text)
        own = {k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for k in range(1, 6)}
        yield any(10 * len(s & own[len(next(iter(s)))]) >= 8 * len(s) for s in sets)


def test_pipeline_equals_plain_stages(spark, sf_dir, documents):
    """Every stage on all that the one before it kept, against loops over rows."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == len(set(names)) == 5
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = pq.read_table(f"{sf_dir}/benchmark.parquet").column("text").to_pylist()
    columns = docs.columns
    rows = dict(zip(documents.doc_id, documents.text))

    def after(name):
        nonlocal docs
        docs = corpus_pipeline.written(stage[name](spark, docs, sf_dir), "stage-test")
        assert docs.columns == columns
        return {r.doc_id: r.text for r in docs.collect()}

    rows = {i: t for i, t in rows.items() if plain_kept(t)}
    assert after("quality") == rows
    first = plain_components(list(rows), [plain_fingerprint(t) for t in rows.values()])
    rows = {i: rows[i] for i in set(first)}
    assert after("near_dedup") == rows
    rows = {i: t for (i, t), leaks in zip(rows.items(), plain_leaks(rows.values(), items)) if not leaks}
    assert after("benchmark_decontamination") == rows
    model = pii.trained(docs, "doc_id", "text")
    rows = {i: pii.masked(t, pii.all_spans(t, model, pii.MARGIN)[1]) for i, t in rows.items()}
    assert after("personal_data") == rows
    assert all(r.n_chars == len(rows[r.doc_id]) for r in docs.collect() if rows[r.doc_id] != r.text) and not any(pii.base_spans(t) for t in rows.values())
    pieces = stage["packing"](spark, docs, sf_dir).toPandas()
    check_pieces(pieces, dict(zip(rows, library_ids(rows.values()))), packing.Limits())
    whole = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(whole.doc_id) == set(rows) and whole.length.sum() == pieces.length.sum()


def test_pipeline_on_edges_and_nothing(spark, edge_docs, no_docs, sf_dir):
    for docs, kept in ((edge_docs, [10]), (no_docs, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "stage-test")
        assert [r.doc_id for r in docs.collect()] == kept
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
        assert {r.doc_id for r in pieces} == set(kept)
        # its numbers may look like personal data: what is packed is the text after masking
        assert sum(r.length for r in pieces) == sum(len(x) for x in library_ids([r.text for r in docs.collect()]))
