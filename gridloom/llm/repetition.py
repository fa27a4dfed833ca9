"""Quality rules from repeated substrings, found by a suffix array over the words of each text.

The texts of a batch are sorted together: the first sort key of a suffix is its text, so suffixes
of different texts never tie, and each further round of prefix doubling sorts only the suffixes
that still tie with another one. Neighbours in suffix order give the longest common prefixes (LCP). An LCP interval,
a maximal run of neighbours that share a prefix of some length and no longer one, is one right-maximal repeat;
it is a maximal repeat where its occurrences also have different left neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import as_bytes, sliced

SPACE = b" \t\n\v\f\r"
FOLLOWING = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
#: Words that are sorted together; a longer text is sorted alone.
WORDS_AT_ONCE = 1 << 17


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict: repeats of `least_words` words or more count; they may cover `covered_percent`
    of the words, and the longest may have `longest_percent` of the words or `longest_words` words, whichever is more."""

    least_words: int = 6
    covered_percent: int = 40
    longest_percent: int = 20
    longest_words: int = 100
    fewest_words: int = 50
    window: int = 3
    window_percent: int = 50


def suffix_array(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Order of all suffixes; `words` are numbers, `text` the non-decreasing number of the text of each word."""
    n = len(words)
    size = int(words.max(initial=0)) + 2
    order = np.argsort(text.astype(np.int64) * size + words, kind="stable")
    key = text[order].astype(np.int64) * size + words[order]
    rank = np.empty(n, np.int64)
    head = np.r_[True, key[1:] != key[:-1]]
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    end = np.searchsorted(text, text, "right")
    step = 1
    tied = ~(head & np.r_[head[1:], True])
    slots = np.flatnonzero(tied)
    while len(slots):
        at = order[slots]
        after = at + step
        follow = np.where(after < end[at], rank[np.minimum(after, n - 1)] + 1, 0)
        group = rank[at]
        by = np.argsort(group * (n + 2) + follow, kind="stable")
        at, group, follow = at[by], group[by], follow[by]
        order[slots] = at
        head = np.r_[True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])]
        rank[at] = np.maximum.accumulate(np.where(head, slots, 0))
        slots = slots[~(head & np.r_[head[1:], True])]
        step *= 2
    return order


def common_prefixes(order: np.ndarray, words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """LCP in words of each suffix in order with the one before it; the first has 0.

    Lengths grow from a binary search on hashes of windows of 1, 2, 4 .. words, longest first. Equal hashes are taken
    as equal windows: 64 bits over the words of one text.
    """
    n = len(words)
    end = np.searchsorted(text, text, "right")
    here, before = order[1:].copy(), order[:-1].copy()
    same = text[here] == text[before]
    lcp = np.zeros(n, np.int64)
    alive = np.flatnonzero(same & (words[here] == words[before]))
    tables = [_mixed(words.astype(np.uint64))]
    reach = alive
    step = 1
    while len(reach):
        table = tables[-1]
        a, b = here[reach], before[reach]
        fits = (a + 2 * step <= end[a]) & (b + 2 * step <= end[b])
        reach, a, b = reach[fits], a[fits], b[fits]
        equal = (table[a] == table[b]) & (table[a + step] == table[b + step])
        reach = reach[equal]
        if not len(reach):
            break
        longer = np.zeros(n, np.uint64)
        longer[: n - step] = _mixed(table[: n - step] * np.uint64(0x9E3779B97F4A7C15) + table[step:])
        tables.append(longer)
        step *= 2
    got = np.zeros(len(alive), np.int64)
    a, b = here[alive], before[alive]
    for level in range(len(tables) - 1, -1, -1):
        step = 1 << level
        fits = (a + got + step <= end[a]) & (b + got + step <= end[b])
        x, y = np.where(fits, a + got, 0), np.where(fits, b + got, 0)
        got += step * (fits & (tables[level][x] == tables[level][y]))
    lcp[alive + 1] = got
    return lcp


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def lcp_intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, length) of every LCP interval of `least` words or more: suffixes first..last share `length` words."""
    stack: list[tuple[int, int]] = []
    for i in np.flatnonzero((lcp >= least) | (np.r_[0, lcp[:-1]] >= least)).tolist():
        length = int(lcp[i])
        first = i - 1
        while stack and stack[-1][1] > length:
            first, longer = stack.pop()
            yield first, i - 1, longer
        if length >= least and (not stack or stack[-1][1] < length):
            stack.append((first, length))
    last = len(lcp) - 1
    while stack:
        first, length = stack.pop()
        yield first, last, length


def maximal_repeats(order: np.ndarray, lcp: np.ndarray, words: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The LCP intervals whose occurrences have different words before them."""
    before = np.where((order > 0) & (text[order] == text[np.maximum(order - 1, 0)]), words[np.maximum(order - 1, 0)], -1)
    open_left = before == -1  # a text's begin differs from everything
    changes = np.cumsum(np.r_[False, (before[1:] != before[:-1]) | open_left[1:] | open_left[:-1]])
    return [(a, b, length) for a, b, length in lcp_intervals(lcp, least) if changes[a] != changes[b]]


def _longest_at(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Length of the longest repeat that begins at each position."""
    longest = np.zeros(len(order), np.int64)
    longest[order] = np.maximum(lcp, np.r_[lcp[1:], 0])
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Whether each word lies in a repeat of `least` words or more: the union of the spans.

    The spans of maximal repeats and those of the longest repeat at each position have the same union.
    """
    reach = np.where(longest >= least, np.arange(len(longest)) + longest, 0)
    return np.maximum.accumulate(reach) > np.arange(len(longest))


def measures(texts: list[bytes], rules: Rules) -> dict[str, np.ndarray]:
    """The columns of `judged` for a list of texts."""
    out = {name: np.zeros(len(texts), np.int64) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")}
    held: list[tuple[int, list[bytes]]] = []
    waiting = 0
    for i, raw in enumerate(texts):
        words = raw.split()
        out["n_words"][i] = len(words)
        out["word_chars"][i] = len(raw.translate(None, SPACE + FOLLOWING))
        out["n_symbols"][i] = len(raw) - len(raw.translate(None, SYMBOLS))
        lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        if held and waiting + len(words) > WORDS_AT_ONCE:
            _repeats(held, rules, out)
            held, waiting = [], 0
        if words:
            held.append((i, words))
            waiting += len(words)
    if held:
        _repeats(held, rules, out)
    return out


def _repeats(held: list[tuple[int, list[bytes]]], rules: Rules, out: dict[str, np.ndarray]) -> None:
    numbers: dict[bytes, int] = {}
    size = [len(words) for _, words in held]
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for _, words in held for w in words), np.int64, sum(size))
    text = np.repeat(np.arange(len(held)), size)
    order = suffix_array(words, text)
    lcp = common_prefixes(order, words, text)
    longest = _longest_at(order, lcp)
    begin = np.r_[0, np.cumsum(size)[:-1]]
    row = np.array([i for i, _ in held])
    out["n_repeat_words"][row] = np.add.reduceat(covered(np.minimum(longest, rules.window), rules.window).astype(np.int64), begin)
    out["covered_words"][row] = np.add.reduceat(covered(longest, rules.least_words).astype(np.int64), begin)
    for first, _, length in maximal_repeats(order, lcp, words, text, rules.least_words):
        at = row[text[order[first]]]
        out["longest_repeat"][at] = max(out["longest_repeat"][at], length)


def verdicts(m: dict[str, np.ndarray], rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)."""
    n = m["n_words"]
    base_failed = (n < rules.fewest_words) | (100 * m["n_repeat_words"] > rules.window_percent * n)
    too_long = m["longest_repeat"] > np.maximum(rules.longest_words, n * rules.longest_percent // 100)
    return base_failed, ~base_failed & (100 * m["covered_words"] <= rules.covered_percent * n) & ~too_long


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def judged(docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, the base counts, base_failed, kept, covered_words and longest_repeat of every row.

    Words are runs of anything but ASCII white space. A null text has none and fails; so does an empty one. Rows are
    judged one by one: repeated rows come back as often, null keys stay, an empty table gives none. Other
    columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            m = measures(batch.column(1).to_pylist(), rules)
            base_failed, kept = verdicts(m, rules)
            columns = [batch.column(0), *(pa.array(m[name]) for name in MEASURES), pa.array(base_failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, [key, *MEASURES, "base_failed", "kept"])

    rows = docs.select(F.col(key), as_bytes(text).alias("__text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"`{key}` {kind}", *(f"{name} long" for name in MEASURES), "base_failed boolean", "kept boolean"]))


def kept_documents(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The rows of `docs` that pass the rules, with all of their columns, row by row.

    Null and empty texts fail, repeated rows and null keys are judged like any other, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            raw = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).fill_null(b"")
            yield batch.filter(pa.array(verdicts(measures(raw.to_pylist(), rules), rules)[1]))

    return docs.mapInArrow(run, docs.schema)
