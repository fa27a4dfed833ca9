"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans.

The field scores whole candidate segments: number of digits, checksum, parts, separators, shape and
the characters and the word around it. A dynamic program over the cuts of a region picks
boundaries and kinds together; a segment has `MOST_PIECES` pieces at most (a run of letters, a run of digits or another
character), so the work is linear in the text and a region passes through it piece by piece: the features of the
segments that end at a cut are dropped when they are scored. Regions reach as far from a digit or an at sign as a
segment can, so no segment is seen in part. A run of more than `LONGEST_RUN` letters or digits is in no segment: mail
addresses and host names have none.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import sliced

KINDS = ("email", "ip", "card", "phone")

TRIGGER = re.compile(r"[0-9@]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
NUMBER_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(2 * d - 9 * (d > 4) for d in values[1::2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the base patterns, by kind and start; ends are exclusive, in code points.

    The patterns are searched from the characters that they cannot do without, which gives the leftmost matches in
    time that grows with the text also where it is one run of digits or letters.
    """
    if not TRIGGER.search(text):
        return []
    found: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        until = DOMAIN.match(text, at)
        if until:
            start = at
            while start > done and not NOT_LOCAL.match(text, start - 1):
                start -= 1
            if start < at:
                found.append(("email", start, until.end()))
                done = until.end()
        at = text.find("@", at + 1)
    for chain in NUMBER_CHAIN.finditer(text):
        if chain.group().count(".") >= 3:
            cuts = [m.span() for m in re.finditer("[0-9]+", chain.group())]
            for i in range(0, len(cuts) - 3, 4):
                if all(_octet(chain.group()[a:b]) for a, b in cuts[i : i + 4]):
                    found.append(("ip", chain.start() + cuts[i][0], chain.start() + cuts[i + 3][1]))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append(("phone", *m.span()))
    return found


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


# --- candidate segments -------------------------------------------------------------------------

#: Pieces of a segment, and letters or digits in a row: no part of an address is longer.
MOST_PIECES, LONGEST_RUN = 16, 64
PIECE = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")
INSIDE = set(" .-()+@_%")


def _breaks(piece: str) -> bool:
    """Whether no segment holds this piece."""
    return len(piece) > LONGEST_RUN or not (piece[0].isascii() and piece[0].isalnum()) and piece not in INSIDE


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold every possible segment: up to `MOST_PIECES` around the triggers, without pieces that no segment holds."""
    done = 0
    while trigger := TRIGGER.search(text, done):
        start = trigger.start()
        for piece in PIECE.findall(text[max(done, start - MOST_PIECES * (LONGEST_RUN + 1)) : start])[: -MOST_PIECES : -1]:
            if _breaks(piece):
                break
            start -= len(piece)
        end, since = start, 0
        for m in PIECE.finditer(text, start):
            piece = m.group()
            since = 0 if piece == "@" or piece[0] in "0123456789" else since + 1
            if _breaks(piece) or since >= MOST_PIECES and end > trigger.start():
                end = max(end, trigger.end()) if end > trigger.start() else m.end()
                break
            end = m.end()
        yield start, end
        done = max(end, trigger.end())


@dataclass
class Lattice:
    """The pieces of a region and its candidate segments (first piece, behind the last, features)."""

    text: str
    cuts: list[int]
    segments: list[tuple[int, int, list[str]]]


def segments_by_end(region: str) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """For each piece its end and the candidate segments that end there: (first piece, start, end)."""
    starts: deque[tuple[int, int, bool]] = deque(maxlen=MOST_PIECES)  # of the last pieces: number, place, whether one may begin there
    for number, m in enumerate(PIECE.finditer(region)):
        piece = m.group()
        if _breaks(piece):
            starts.clear()
            yield m.end(), []
            continue
        starts.append((number, m.start(), piece.isalnum() or piece in "+("))
        found = []
        if piece.isalnum():
            for first, place, begins in starts:
                body = region[place : m.end()] if begins else ""
                if begins and TRIGGER.search(body) and sum(c.isdigit() for c in body) <= 24:
                    found.append((first, place, m.end()))
        yield m.end(), found


def lattice(text: str, start: int, end: int) -> Lattice:
    region, cuts, segments = text[start:end], [0], []
    for j, (cut, found) in enumerate(segments_by_end(region)):
        cuts.append(cut)
        segments += [(i, j + 1, features(region, a, b)) for i, a, b in found]
    return Lattice(region, cuts, segments)


def features(text: str, start: int, end: int) -> list[str]:
    """Features of the whole segment text[start:end]."""
    body = text[start:end]
    digits = "".join(c for c in body if c.isdigit())
    shape = re.sub(r"[0-9]+", "d", re.sub(r"[A-Za-z]+", "a", body))
    names = body.rpartition("@")
    parts = body.split(".")
    left, right = text[start - 1 : start], text[end : end + 1]
    word = re.findall(r"[A-Za-z]+", text[max(0, start - 16) : start])
    out = [
        "bias",
        f"digits={len(digits)}",
        f"shape={shape if len(shape) < 24 else 'long'}",
        f"at={min(body.count('@'), 2)}",
        f"letters={bool(re.search('[A-Za-z]', body))}",
        f"separators={''.join(sorted(set(re.sub('[0-9A-Za-z]', '', body))))}",
        f"left={_class(left)}",
        f"right={_class(right)}",
        f"open={body.count('(') != body.count(')')}",
        f"word={word[-1].lower() if word else ''}",
    ]
    if names[1]:
        out.append(f"domain={bool(re.fullmatch(r'[A-Za-z0-9-]+([.][A-Za-z0-9-]+)*[.][A-Za-z]{2,}', names[2].removeprefix(' ')))}")
        out.append(f"local={bool(re.fullmatch(r'[A-Za-z0-9._%+-]+', names[0].removesuffix(' ')))}")
    if not names[1] and 13 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    if len(parts) == 4 and all(p.isdigit() for p in parts):
        out.append(f"octets={all(_octet(p) for p in parts)}")
    groups = re.findall("[0-9]+", body)
    if groups and not names[1]:
        out.append(f"groups={','.join(str(min(len(g), 6)) for g in groups[:6])}")
        out.append(f"plus={body[0] == '+'}&{'8-15' if 8 <= len(digits) <= 15 else 'other'}")
    return out


def _class(c: str) -> str:
    return "edge" if not c else "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c if c in ".-+@(/_" else "other"


# --- the model ----------------------------------------------------------------------------------


class SemiMarkov:
    """Weights by (kind, feature); a piece outside of segments scores 0."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None) -> None:
        self.weights = weights or {}
        self.none = np.zeros(len(KINDS))

    def scores(self, of: Lattice) -> list[np.ndarray]:
        known, none = self.weights, self.none
        return [sum((known.get(f, none) for f in names), none) for _, _, names in of.segments]

    def best(self, region: str, margin: float) -> list[Span]:
        """The best segmentation, by dynamic programming over the cuts; `margin` is asked of every segment."""
        known, none = self.weights, self.none
        total, came, cuts = array("d", [0.0]), array("q", [-1]), array("q", [0])  # `came`: first piece and kind, -1 outside
        for cut, found in segments_by_end(region):
            top, by = total[-1], -1
            for i, a, b in found:
                score = sum((known.get(f, none) for f in features(region, a, b)), none)
                kind = int(np.argmax(score))
                if score[kind] > margin and total[i] + score[kind] - margin > top:
                    top, by = total[i] + float(score[kind]) - margin, i * len(KINDS) + kind
            total.append(top)
            came.append(by)
            cuts.append(cut)
        out, j = [], len(came) - 1
        while j:
            if came[j] < 0:
                j -= 1
            else:
                i, kind = divmod(came[j], len(KINDS))
                out.append((KINDS[kind], cuts[i], cuts[j]))
                j = i
        return out[::-1]

    def fit(self, examples: list[tuple[Lattice, list[Span]]], rounds: int = 12, rate: float = 0.4, decay: float = 1e-3) -> "SemiMarkov":
        """Stochastic gradient ascent on the likelihood of the given segmentations; sums run over all segmentations."""
        order = random.Random(7)
        examples = list(examples)
        for step in range(rounds):
            order.shuffle(examples)
            for of, spans in examples:
                self._step(of, spans, rate / (1 + step / 3), decay)
        return self

    def _step(self, of: Lattice, spans: list[Span], rate: float, decay: float) -> None:
        n = len(of.cuts) - 1
        scores = self.scores(of)
        into: list[list[int]] = [[] for _ in range(n + 1)]
        out_of: list[list[int]] = [[] for _ in range(n + 1)]
        each = [float(np.logaddexp.reduce(s)) for s in scores]
        for s, (i, j, _) in enumerate(of.segments):
            into[j].append(s)
            out_of[i].append(s)
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _log_sum([ahead[j - 1], *(ahead[of.segments[s][0]] + each[s] for s in into[j])])
        for i in range(n - 1, -1, -1):
            behind[i] = _log_sum([behind[i + 1], *(behind[of.segments[s][1]] + each[s] for s in out_of[i])])
        wanted = {(a, b): KINDS.index(kind) for kind, a, b in spans}
        for s, (i, j, names) in enumerate(of.segments):
            kind = wanted.get((of.cuts[i], of.cuts[j]))
            change = -np.exp(np.minimum(0.0, ahead[i] + behind[j] - ahead[n] + scores[s]))
            if kind is not None:
                change[kind] += 1
            if np.abs(change).max() > 1e-3:
                for name in names:
                    old = self.weights.get(name, self.none)
                    self.weights[name] = old + rate * (change - decay * old)


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


# --- training examples --------------------------------------------------------------------------

#: Regions of the corpus that the weights are fitted on, besides the made-up ones.
SAMPLED_REGIONS = 300
MADE_UP = 294
MARGIN = 2.0


def made_up(n: int) -> list[tuple[str, list[Span]]]:
    """Texts with known spans, drawn by rule: forms that the base patterns see, forms that they miss, and look-alikes."""
    draw = random.Random(11)
    number = lambda k: "".join(draw.choice("0123456789") for _ in range(k))
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 9)))

    def card(sep: str) -> str:
        digits = "4" + number(14)
        digits += next(d for d in "0123456789" if luhn(digits + d))
        return sep.join(digits[i : i + 4] for i in range(0, 16, 4))

    def bad_card() -> str:
        while luhn(digits := number(16)):
            pass
        return digits

    forms = [
        lambda: ("email", f"{word()}{draw.choice(['', '.', '_'])}{draw.choice([word(), number(2)])}@{word()}.{draw.choice(['com', 'org', 'net', 'example.com'])}"),
        lambda: ("email", f"{word()} @ {word()}.{draw.choice(['com', 'org', 'net'])}"),
        lambda: ("email", f"{word()}{draw.choice(['.', '_'])}{word()} @ {word()}.{draw.choice(['com', 'org', 'net'])}"),
        lambda: ("email", f"{word()}{draw.choice(['', '.' + word()])} @ {'.'.join(word() for _ in range(draw.randint(2, 4)))}.{draw.choice(['com', 'org', 'net'])}"),
        lambda: ("ip", ".".join(str(draw.randint(0, 255)) for _ in range(4))),
        lambda: ("card", card(draw.choice(["", " ", "-", "."]))),
        lambda: ("phone", f"+{draw.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}"),
        lambda: ("phone", f"+{draw.randint(1, 99)} {number(3)} {number(3)} {number(4)}"),
        lambda: ("phone", f"({number(3)}) {number(3)}-{number(4)}"),
        lambda: ("phone", f"{number(3)}-{number(3)}-{number(4)}"),
        lambda: (None, bad_card()),
        lambda: (None, f"{draw.randint(1900, 2030)}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02}"),
        lambda: (None, f"{draw.randint(1, 99)}.{draw.randint(0, 9)}.{draw.randint(0, 20)}"),
        lambda: (None, f"{draw.randint(256, 999)}.{draw.randint(256, 999)}.{draw.randint(0, 999)}.{draw.randint(0, 999)}"),
        lambda: (None, number(draw.randint(1, 15))),
        lambda: (None, f"{number(3)}, {number(3)} {word()} {number(4)}"),
        lambda: (None, f"{word()}{number(4)}{word()}{number(6)}"),
        lambda: (None, " ".join(draw.choice("wvxk") + part for part in card(" ").split())),
        lambda: (None, f"{word()} @{word()}"),
        lambda: (None, f"{number(2)}:{number(2)}:{number(2)}"),
        lambda: (None, f"{number(1)} {number(2)} {number(3)} {number(2)}"),
    ]
    out = []
    for i in range(n):
        kind, body = forms[i % len(forms)]()
        before, after = f"{word()} {word()}{draw.choice([' ', ', ', ': '])}", f"{draw.choice([' ', '. ', ', ', '!! '])}{word()} {word()}"
        out.append((before + body + after, [(kind, len(before), len(before) + len(body))] if kind else []))
    return out


def _example(text: str, spans: list[Span]) -> list[tuple[Lattice, list[Span]]]:
    found = []
    for start, end in regions(text):
        of = lattice(text, start, end)
        found.append((of, [(k, a - start, b - start) for k, a, b in spans if a >= start and b <= end]))
    return found


def sampled_regions(docs: DataFrame, key: str, text: str, n: int) -> list[str]:
    """Up to `n` stretches of text around triggers, those with the smallest hashes among all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, str]] = []
        for batch in sliced(batches, 0):
            for value in batch.column(0).to_pylist():
                if value and TRIGGER.search(value):
                    m = TRIGGER.search(value)  # one region of each document
                    part = value[max(0, m.start() - 60) : m.start() + 80]
                    best.append((hashlib.md5(part.encode("utf-8", "replace")).hexdigest(), part))
            best = sorted(set(best))[:n]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in best], pa.string()), pa.array([t for _, t in best], pa.string())], ["hash", "part"])

    rows = docs.select(F.col(text).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]")).mapInArrow(run, "hash string, part string")
    return [row.part for row in rows.distinct().orderBy("hash").limit(n).collect()]


@lru_cache(maxsize=4)
def _fitted(parts: tuple[str, ...]) -> SemiMarkov:
    examples = [x for text, spans in made_up(MADE_UP) for x in _example(text, spans)]
    for part in parts:
        examples += _example(part, _apart(base_spans(part)))
    return SemiMarkov().fit(examples)


def _apart(spans: list[Span]) -> list[Span]:
    """Spans without those that overlap an earlier listed one; a segmentation cannot hold both."""
    out: list[Span] = []
    for span in spans:
        if all(span[2] <= a or span[1] >= b for _, a, b in out):
            out.append(span)
    return out


def trained(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SAMPLED_REGIONS) -> SemiMarkov:
    """The field fitted on the base spans of at most `n` regions of the corpus and on made-up texts."""
    return _fitted(tuple(sampled_regions(docs, key, text, n)))


# --- the operator -------------------------------------------------------------------------------


def all_spans(text: str, model: SemiMarkov, margin: float = MARGIN) -> tuple[list[Span], list[Span]]:
    """(base spans, base spans and those that the model adds), each by kind and start. An added span overlaps no base span."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added: list[Span] = []
    if TRIGGER.search(text):
        for start, end in regions(text):
            for kind, a, b in model.best(text[start:end], margin):
                a, b = a + start, b + start
                if all(b <= x or a >= y for x, y in _near(taken, a, b)) and all(b <= x or a >= y for _, x, y in added[-3:]):
                    added.append((kind, a, b))
    order = {kind: i for i, kind in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda s: (order[s[0]], s[1]))


def _near(taken: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    from bisect import bisect_left

    at = bisect_left(taken, (a, b))
    return taken[max(0, at - 6) : at + 6]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def personal_data(docs: DataFrame, model: SemiMarkov | None = None, key: str = "doc_id", text: str = "text", margin: float = MARGIN) -> DataFrame:
    """`key`, the numbers of base spans by kind, base_sha256, spans and n_spans, the number of all spans, of every row.

    spans lists base and added spans as kind:start:end, base_sha256 hashes the same list of base spans alone. Null and
    empty texts have none. Repeated rows and null keys come back as they are, an empty table gives no
    rows; other columns are not looked at.
    """
    weights = (model or trained(docs, key, text)).weights
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = SemiMarkov(shared.value)
        for batch in sliced(batches, 1):
            counts, sums, lists, n = [[] for _ in KINDS], [], [], []
            for value in batch.column(1).to_pylist():
                base, full = all_spans(value or "", field, margin)
                for column, kind in zip(counts, KINDS):
                    column.append(sum(k == kind for k, _, _ in base))
                sums.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                lists.append(_joined(full))
                n.append(len(full))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sums, pa.string()), pa.array(lists, pa.string()), pa.array(n, pa.int64())], [key, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"])

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("__text"))
    return rows.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_spans long")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans are one, named after the first."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def masked_documents(docs: DataFrame, model: SemiMarkov | None = None, key: str = "doc_id", text: str = "text", size: str = "n_chars", margin: float = MARGIN) -> DataFrame:
    """`docs` with personal data masked and the column `size`, if there is one, set to the new number of characters.

    Rows are masked one by one: null and empty texts stay as they are, repeated rows and null keys come back as often, an
    empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model or trained(docs, key, text)).weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = SemiMarkov(shared.value)
        for batch in sliced(batches, text):
            at = batch.schema.get_field_index(text)
            old = batch.column(at).to_pylist()
            new = [None if t is None else masked(t, all_spans(t, field, margin)[1]) if TRIGGER.search(t) else t for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            place = batch.schema.get_field_index(size)
            if place >= 0:
                sizes = columns[place].to_pylist()
                columns[place] = pa.array([s if a == b else len(b) for s, a, b in zip(sizes, old, new)], batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
