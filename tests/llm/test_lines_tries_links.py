"""Line deduplication, the conversation trie and token alignment against plain versions."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridloom.llm import alignment, line_dedup, prefix_trie
from gridloom.llm.queries import QUERIES
from tests.llm.conftest import EDGES, with_clashes


# ---- lines


def plain_lines(rows, characters=40, documents=5):
    """(doc_id, n_lines, n_dropped, text) of each row; a row is a document."""
    blanks = " \t\n\v\f\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [[(line, line.strip(blanks).translate(lower)) for line in (text or "").split("\n")] for _, text in rows]
    held = Counter(k for lines in split for k in {k for _, k in lines if len(k) >= characters})
    holder = {}
    for (one, _), lines in zip(rows, split):
        for _, k in lines:
            holder[k] = max(holder.get(k, -(1 << 63)), -(1 << 63) if one is None else one)
    for (one, _), lines in zip(rows, split):
        at = -(1 << 63) if one is None else one
        kept = [line for line, k in lines if held[k] < documents or holder[k] == at]
        yield one, len(lines), len(lines) - len(kept), "\n".join(kept)


def line_rows():
    draw = np.random.default_rng(5)
    common = [f"  {'Ä' if i % 3 else 'B'} line number {i} that many documents hold together\t" for i in range(12)]
    rows = []
    for doc in range(150):
        lines = [common[i] if draw.random() < 0.7 else common[i].upper() for i in draw.integers(0, 12, 6)]
        lines += [f"own line {doc} of a document, long enough to be looked at", "short", ""]
        rows.append((int(doc) if doc % 29 else None, "\n".join(draw.permutation(lines).tolist())))
    return [*rows, *rows[:7], *EDGES, (3, "\n\n"), (10**15, common[0] * 3), (-5, common[1])]


def test_lines_equal_plain_version(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HASHES_PER_SHARD", 7)
    monkeypatch.setattr(line_dedup, "PROBES_PER_COPY", 3)
    rows = line_rows()
    docs = with_clashes(spark, rows, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.without_shared_lines(docs).collect())
    assert got == Counter(plain_lines(rows))
    assert sum(n * c for (_, _, n, _), c in got.items()) > 300


def test_lines_with_other_limits_and_nothing(spark, no_docs):
    rows = [(i, f"x{i % 3}\ny") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.without_shared_lines(docs, line_dedup.Limits(2, 3)).collect())
    assert got == Counter(plain_lines(rows, 2, 3))
    assert line_dedup.without_shared_lines(no_docs).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 30000])
def test_perfect_hash_is_minimal_and_perfect(n):
    draw = np.random.default_rng(n)
    hashes = np.zeros(n, line_dedup.HASH)
    hashes["hi"], hashes["lo"] = np.arange(n) // 3, draw.integers(0, 2**63, n)  # equal halves are no matter
    perfect = line_dedup.PerfectHash.over(hashes)
    assert sorted(perfect.slots(hashes).tolist()) == list(range(n))
    others = np.zeros(1000, line_dedup.HASH)
    others["hi"], others["lo"] = 10**9, draw.integers(0, 2**63, 1000)
    index = line_dedup.index_of(hashes, np.full(n, 9), np.arange(n), 5) if n else None
    if index:
        assert len(line_dedup.probed(index, others, 5)[0]) == 0
        reach, holders = line_dedup.probed(index, hashes, 5)
        assert reach.tolist() == holders.tolist() == list(range(n))


def test_line_index_is_small():
    draw = np.random.default_rng(1)
    hashes = np.zeros(100_000, line_dedup.HASH)
    hashes["hi"], hashes["lo"] = draw.integers(0, 2**63, 100_000), draw.integers(0, 2**63, 100_000)
    index = line_dedup.index_of(hashes, np.where(np.arange(100_000) % 100, 1, 7), np.arange(100_000), 5)
    assert sum(len(x) for x in index["levels"]) + sum(len(index[c]) for c in ("prints", "counts", "shared", "holders")) < 6 * 100_000


# ---- conversations


def plain_trie(rows, every=100, most=6):
    """Nodes of the rebuilt conversations of (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(np.fmod(c, every))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, d == len(path)))
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, held in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(held) - 1) * len(path[-1][1]) if path else 0
    smallest = {p: min(c for c, _ in m) for p, m in members.items()}
    for path, held in members.items():
        ends = ",".join(str(c) for c, end in sorted(held) if end)
        yield smallest[path], len(path), smallest[path[:-1]] if path else None, len(held), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()


def trie_rows(frame):
    return Counter((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in frame.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_equals_plain_version(spark, seed, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ROWS_PER_SHARD", 9)  # many shards: nodes and copies lie across their borders
    monkeypatch.setattr(prefix_trie, "IDS_PER_BLOCK", 3)
    draw = np.random.default_rng(seed)
    rows = []
    for c in range(0, 260, 2):
        copies = draw.random() < 0.4
        turns = 9 if copies else int(draw.choice([1, 2, 3, 8, 9, 17]))
        for t in range(turns):
            said = "same" if copies else f"{draw.choice(['a', 'bé', ''])}"
            rows.append((c - 40, t, ["user", "assistant"][t % 2], said))
    rows += [(1000, None, None, None), (1000, 1, "user", None), (1001, 0, None, "x" * 5000), (None, 1, "user", "no key"), (7001, 3, "user", "absent opener"), (-130, 0, "user", "same")]
    turns = with_clashes(spark, rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert trie_rows(prefix_trie.shared_opening_trie(turns)) == Counter(plain_trie(rows))


def test_trie_of_long_conversations_repeated_rows_and_nothing(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(300)] + [(2, t, "user", f"t{t}") for t in range(299)] + [(3, 0, "user", "z")] * 3
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = trie_rows(prefix_trie.prefix_trie(prefix_trie.turn_sequences(turns)))
    plain = Counter(plain_trie(rows, every=1, most=1))
    assert got == plain and len(got) == 304
    assert prefix_trie.shared_opening_trie(turns.where("false")).count() == 0


# ---- token alignment


def plain_links(texts):
    """The columns of each text, by walking over tokens and offsets."""
    import sentencepiece
    from tokenizers import Tokenizer

    paths = alignment.default_paths()
    a_tool = Tokenizer.from_file(paths.a)
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=paths.b)
    spelled = {letter: bytes([b]) for letter, b in alignment.byte_of_letter().items()}
    rows, counts = [], Counter()
    for text in texts:
        text = text or ""
        a = a_tool.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tool.encode(text) if text else []
        a_raw = [b"".join(spelled[c] for c in a_tool.id_to_token(i)) for i in a]
        b_raw = [bytes([int(p[3:5], 16)]) if b_tool.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_tool.id_to_piece(i)) for i in b)]
        if not b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
            rows.append(([], [], [], []))
            continue
        a_end, b_end = np.cumsum([len(x) for x in a_raw]).tolist(), np.cumsum([len(x) for x in b_raw]).tolist()
        groups, begin = [], 0
        for cut in sorted(set(a_end) & set(b_end)):
            groups.append(([i for i, e in zip(a, a_end) if begin < e <= cut], [i for i, e in zip(b, b_end) if begin < e <= cut]))
            begin = cut
        b_at = dict(zip(b_end, b))
        links = [(i, b_at[e]) for i, e in zip(a, a_end) if e in b_at]
        counts.update(links)
        rows.append((a, b, groups, links))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    for a, b, groups, links in rows:
        form = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(form.encode()).hexdigest() if groups else ""


LINK_COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD_TEXTS = [
    "a  b", " a", "a ", "  ", "\n", "a\n\nb\n", "a \n b", "\ta\tb", "x▁y", "▁", "<|endoftext|> a<s>b</s><unk>", "<0x41>", "it's I'LL 12345 6.7", "中文 字🎉🎉 ﬁ", "a b c\x85d",
    "é é", "\x00 \x01", "a\r\nb", "a\x1cb", "word" * 500, "don't  don't\n don't",
]


def test_links_equal_plain_version(spark, monkeypatch):
    texts = [*ODD_TEXTS, *(t for _, t in EDGES if t is None or len(t) < 3000), *ODD_TEXTS[:4]]
    rows = [(i % 20 or None, t) for i, t in enumerate(texts)]
    docs = with_clashes(spark, rows, "doc_id long, text string").repartition(4)
    want = Counter((i, *x) for (i, _), x in zip(rows, plain_links(texts)))
    for known in (1 << 17, 3, 0):  # pairs beyond the known ones are counted by a join
        got = alignment.token_links(docs, known_pairs=known).collect()
        assert Counter((r.doc_id, *(r[c] for c in LINK_COLUMNS)) for r in got) == want


def test_link_query_equals_plain_version(spark, sf_dir, documents):
    got = QUERIES["op13_token_alignment"](spark, sf_dir).toPandas().set_index("doc_id").loc[documents.doc_id]
    want = list(plain_links(documents.text))
    assert list(got[list(LINK_COLUMNS)].itertuples(index=False, name=None)) == want
    assert (got.n_groups < got.n_a).any() and (got.n_best < got.n_links).any()


def test_link_counts_name_every_link(spark, sf_dir, documents):
    from gridloom.llm.common import written

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    rows = written(alignment.aligned_rows(docs, alignment.default_paths()), "test-alignments")
    table = alignment.link_counts(rows, alignment.default_paths()).collect()
    assert len({(r.a_id, r.b_id) for r in table}) == len(table)
    assert sum(r.n for r in table) == sum(x[3] for x in plain_links(ODD_TEXTS))


def test_links_of_long_texts_and_nothing(spark, edge_docs, no_docs):
    got = alignment.token_links(edge_docs).collect()
    assert len(got) == len(EDGES) and all(r.n_groups <= min(r.n_a, r.n_b) for r in got)
    assert alignment.token_links(no_docs).count() == 0


def test_cached_chunks_give_the_same_parts(monkeypatch):
    texts = ["one two  three\nfour", "one two  three\nfour", " one\n\n two ", "x\ty one two"]
    tool = alignment.Aligner(alignment.default_paths())
    whole = ["".join(p.groups.decode() + ";" for p in tool._whole(t)) for t in texts]
    for bound in (1 << 20, 0):
        monkeypatch.setattr(alignment, "CACHED_BYTES", bound)
        for _ in range(2):
            assert ["".join(p.groups.decode() + ";" for p in parts) for parts in tool.align(texts)] == whole
