"""Token counts by a finite-state transducer compiled from a tokenizer's merges.

Inside a word, byte-pair encoding is a rewriting of symbols (a byte, or a byte that ends the word). The encoding of every
prefix of a word ends in one token, and the encoding without that token is the encoding of a shorter
prefix. So a deterministic machine can read the symbols from left to right. Its state holds
the longest suffix that begins a token and, for each place in it where a token could still begin, the last token before
that place and how many tokens fewer there are than now. These are finitely many. A transition carries the change of the
token count. States and transitions are worked out when a text first needs them and then stay in
the worker's tables.

A batch of texts is one row of symbols that is cut into chunks of equal length, which advance side by side. A chunk
that begins inside a word starts from an unknown state, which stays unknown until the word ends. So the map of a
chunk from entry to exit state is constant from its first word end on; before that it is the run of its leading symbols. The maps
are composed by a prefix scan over the chunks: the last constant map before a chunk gives its entry
state, and the leading symbols, also of words longer than a chunk, are run from there.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import sliced
from gridloom.llm.tokens import NORMALIZER, SPLITTER, WORD_END, default_path

UNKNOWN, START = 0, 1
FINAL = 256
#: Cells of the tables (states times symbols in use, 5 bytes each) beyond which a worker begins again with empty ones.
MOST_CELLS = 40_000_000
#: Rows that the tables grow by.
MORE_STATES = 1 << 16
CHUNK = 192
#: Bytes of text that advance side by side.
BYTES_AT_ONCE = 1 << 22


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves, the
    others are numbered from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Machine:
    """The transducer of one vocabulary with merges and a mark for word ends."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model = rules["model"]
        if rules["normalizer"] != NORMALIZER or rules["pre_tokenizer"] != SPLITTER or model["end_of_word_suffix"] != WORD_END:
            raise ValueError("the transducer is written for lower-cased words with word ends")
        self.library = Tokenizer.from_file(path)
        self.special = [token["content"] for token in rules["added_tokens"] if token["special"]]
        self.special_cut = re.compile("|".join(re.escape(s) for s in self.special)) if self.special else None
        letters = byte_letters()

        def symbols(token: str) -> str:
            ends = token.endswith(WORD_END)
            body = [letters[c] for c in (token[: -len(WORD_END)] if ends else token)]
            return "".join(map(chr, body[:-1])) + chr(body[-1] + FINAL * ends)

        self.token = {symbols(t): i for t, i in model["vocab"].items()}
        self.spelled = {i: s for s, i in self.token.items()}
        spelled = {t: i for t, i in model["vocab"].items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = spelled[left], spelled[right], spelled[left + right]
            self.merge.setdefault((a, b), (rank, whole))
            self.parts.setdefault(whole, (rank, a, b))
        self.prefixes = {s[:n] for s in self.token for n in range(1, len(s) + 1)}
        self.beside: dict[tuple[int, int], bool] = {}
        self.stands = {t: t not in self.parts or self._apart(*self.parts[t][1:], self.parts[t][0]) for t in sorted(self.spelled, key=len_of(self.spelled))}
        self._clear()

    def _clear(self) -> None:
        self.states: list[tuple] = [(), ("", ((-1, 0),))]
        self.number: dict[tuple, int] = {self.states[START]: START}
        self.column = np.full(2 * FINAL, -1, np.int32)  # symbol -> column of the tables
        self.columns = 0
        self.next = np.full((1024, 64), -1, np.int32)
        self.change = np.zeros((1024, 64), np.int8)

    def _apart(self, left: int, right: int, limit: int | None = None) -> bool:
        """Whether two tokens stay apart side by side. Undo their merges, the later one first, and ask at each step
        whether an earlier merge would have joined the pieces at the border. With `limit`, only merges before it count:
        then it tells whether the merge of this rank itself is reached."""
        bound = len(self.merge) if limit is None else limit
        while True:
            joined = self.merge.get((left, right))
            if joined is not None and joined[0] < bound:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            # equal ranks are undone right first: the leftmost pair is merged first
            if b is None or (a is not None and a[0] > b[0]):
                bound, left = min(bound, a[0]), a[2]
            else:
                bound, right = min(bound, b[0] + 1), b[1]

    def _fits(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        key = (left, right)
        known = self.beside.get(key)
        if known is None:
            known = self.beside[key] = self._apart(left, right)
        return known

    def _step(self, state: int, symbol: int) -> tuple[int, int]:
        """(next state, change of the count) of a known state."""
        suffix, places = self.states[state]
        grown = suffix + chr(symbol)
        # places[i]: (last token, tokens fewer than now) before grown[i:]
        last = None
        for i, place in enumerate(places):
            if place is None:
                continue
            token = self.token.get(grown[i:])
            if token is not None and self.stands[token] and self._fits(place[0], token):
                last = (token, place[1] + 1)
                break
        if last is None:
            raise ValueError("no token ends here; the vocabulary is not complete")
        token, change = last
        if symbol >= FINAL:
            return START, change
        kept = 0
        while grown[kept:] and grown[kept:] not in self.prefixes:
            kept += 1
        moved = tuple(
            (place[0], place[1] - change) if place is not None and grown[i:] in self.prefixes else None for i, place in enumerate(places) if i >= kept
        )
        key = (grown[kept:], (*moved, (token, 0)))
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
            if number >= len(self.next):
                more = min(len(self.next), MORE_STATES)
                self.next = np.vstack([self.next, np.full_like(self.next[:more], -1)])
                self.change = np.vstack([self.change, np.zeros_like(self.change[:more])])
        return number, change

    def _columns_of(self, symbols: np.ndarray) -> np.ndarray:
        """Columns of the tables for symbols; new symbols get the next ones."""
        for symbol in np.unique(symbols):
            if self.column[symbol] < 0:
                self.column[symbol] = self.columns
                self.columns += 1
                if self.columns > self.next.shape[1]:
                    self.next = np.hstack([self.next, np.full_like(self.next, -1)])
                    self.change = np.hstack([self.change, np.zeros_like(self.change)])
        self.symbol = np.flatnonzero(self.column >= 0)[np.argsort(self.column[self.column >= 0])]
        final = self.symbol >= FINAL
        self.next[UNKNOWN, : self.columns] = np.where(final, START, UNKNOWN)
        return self.column[symbols]

    def _advance(self, state: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        to = self.next[state, column]
        missing = np.flatnonzero(to < 0)
        if len(missing):
            width = self.next.shape[1]
            for code in np.unique(state[missing].astype(np.int64) * width + column[missing]).tolist():
                s, c = divmod(code, width)
                number, change = self._step(s, int(self.symbol[c]))
                self.next[s, c], self.change[s, c] = number, change
            to = self.next[state, column]
        return to, self.change[state, column]

    # -- texts to symbols ------------------------------------------------------------------------

    def symbols(self, text: str) -> np.ndarray:
        """The symbols of a text without white space; the last byte of a word is a final one."""
        if text.isascii() or not BEYOND_LATIN_1.search(text):
            code = np.frombuffer(text.lower().encode("latin-1"), np.uint8)
            kind = LATIN_1[code]
        else:
            text = self.library.normalizer.normalize_str(text)
            code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            kind = self._kinds(text, code)
        return _word_symbols(text, code, kind)

    def _kinds(self, text: str, code: np.ndarray) -> np.ndarray:
        """Letter, number, blank or other, as the vocabulary's own splitter has it, asked once for each character."""
        table = self.__dict__.setdefault("kinds", {i: int(k) for i, k in enumerate(LATIN_1.tolist())})
        for c in set(text):
            if ord(c) not in table:
                words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(f"a{c}a")]
                table[ord(c)] = LETTER if len(words) == 1 else BLANK if len(words) == 2 else self._mark_kind(c)
        seen, at = np.unique(code, return_inverse=True)
        return np.array([table[int(v)] for v in seen], np.uint8)[at]

    def _mark_kind(self, c: str) -> int:
        """Two of a number are two words; two other marks are one."""
        return NUMBER if len(self.library.pre_tokenizer.pre_tokenize_str(c + c)) == 2 else OTHER

    # -- counting --------------------------------------------------------------------------------

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        extra = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, text in enumerate(texts):
            pieces = [text]
            if self.special_cut and self.special_cut.search(text):
                pieces = self.special_cut.split(text)
                extra[i] = len(pieces) - 1  # a special string is one token and ends the word before it
            for piece in pieces:
                found = self.symbols(piece)
                if len(found):
                    parts.append(found)
                    owner.append(i)
        if not parts:
            return extra
        if len(self.states) * self.next.shape[1] > MOST_CELLS:
            self._clear()
        change = self.run(np.concatenate(parts))
        begin = np.r_[0, np.cumsum([len(p) for p in parts])[:-1]]
        np.add.at(extra, np.array(owner), np.add.reduceat(change, begin, dtype=np.int64))
        return extra

    def run(self, symbols: np.ndarray) -> np.ndarray:
        """The change of the count at every symbol; the row begins at a word and ends with one."""
        columns = self._columns_of(symbols)
        n = len(symbols)
        chunks = -(-n // CHUNK)
        grid = np.zeros(chunks * CHUNK, columns.dtype)
        grid[:n] = columns
        grid[n:] = columns[-1]  # final symbols after the end change nothing from the unknown state
        grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
        final = symbols >= FINAL
        inside = np.r_[False, ~final[CHUNK - 1 : -1 : CHUNK]][:chunks]
        state = np.where(inside, UNKNOWN, START).astype(np.int32)
        change = np.zeros((CHUNK, chunks), np.int8)
        rest = n - (chunks - 1) * CHUNK
        for k in range(CHUNK):
            lanes = slice(None) if k < rest else slice(0, chunks - 1)
            state[lanes], change[k, lanes] = self._advance(state[lanes], grid[k, lanes])
        change = np.ascontiguousarray(change.T).reshape(-1)[:n]
        # prefix scan: entry states come from the last chunk whose map is constant
        known = np.maximum.accumulate(np.where(state != UNKNOWN, np.arange(chunks), -1))
        first = np.flatnonzero(inside & np.r_[True, state[:-1] != UNKNOWN][:chunks])
        if len(first):
            ends = np.flatnonzero(final)
            begin = first * CHUNK
            until = ends[np.searchsorted(ends, begin)] + 1
            self._lead(columns, change, begin, until, state[known[first - 1]])
        return change

    def _lead(self, columns: np.ndarray, change: np.ndarray, begin: np.ndarray, until: np.ndarray, state: np.ndarray) -> None:
        """Run the leading symbols of chunks from their entry states."""
        at, state = begin.copy(), state.copy()
        while len(at):
            state, change[at] = self._advance(state, columns[at])
            at = at + 1
            going = at < until
            if not going.all():
                at, until, state = at[going], until[going], state[going]


def len_of(spelled: dict[int, str]):
    return lambda token: len(spelled[token])


BLANK, LETTER, NUMBER, OTHER = range(4)
BEYOND_LATIN_1 = re.compile("[^\x00-\xff]")


def _latin_1() -> np.ndarray:
    from gridloom.llm.tokens import BLANKS, DIGITS, LETTERS

    table = np.full(256, OTHER, np.uint8)
    for kind, chars in ((LETTER, LETTERS), (NUMBER, DIGITS), (BLANK, BLANKS)):
        one = re.compile(f"[{chars}]")
        table[[c for c in range(256) if one.match(chr(c))]] = kind
    return table


LATIN_1 = _latin_1()
QUOTE = ord("'")
#: Fixed values of the splitter: what follows a quote at the begin of a word to form a word with it.
TAILS = ("s", "t", "re", "ve", "m", "ll", "d")


def _word_symbols(text: str, code: np.ndarray, kind: np.ndarray) -> np.ndarray:
    n = len(code)
    if not n:
        return np.zeros(0, np.uint16)
    begin = np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)]
    quotes = np.flatnonzero((code == QUOTE) & begin)
    for at in quotes.tolist():
        tail = next((t for t in TAILS if all(at + 1 + i < n and code[at + 1 + i] == ord(c) for i, c in enumerate(t))), None)
        if tail:
            begin[at + 1] = False
            if at + 1 + len(tail) < n:
                begin[at + 1 + len(tail)] = True
    last = np.r_[begin[1:], True]
    word = kind != BLANK
    code, last = code[word], last[word]
    if code.dtype == np.uint8 and not (code > 127).any():
        return code.astype(np.uint16) + FINAL * last.astype(np.uint16)
    size = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
    end = np.cumsum(size) - 1
    out = np.frombuffer(code.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8).astype(np.uint16)
    out[end[last]] += FINAL
    return out


_MACHINES: dict[str, Machine] = {}


def machine(path: str) -> Machine:
    if path not in _MACHINES:
        _MACHINES.clear()
        _MACHINES[path] = Machine(path)
    return _MACHINES[path]


def count_tokens(texts: list[str], path: str) -> Iterator[int]:
    """Tokens of each text, many texts at a time."""
    tool, at = machine(path), 0
    while at < len(texts):
        size, until = 0, at
        while until < len(texts) and (until == at or size < BYTES_AT_ONCE):
            size += len(texts[until])
            until += 1
        yield from tool.counts(texts[at:until]).tolist()
        at = until


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, n_bytes, n_tokens and over_limit of every row.

    Counts are those of the tokenizers library without special tokens added; special strings in a text count as
    the one token that the library takes them for. A null or empty text has 0 bytes and tokens. Repeated rows and null
    keys come back as they are, an empty table gives no rows; other columns are not looked at.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = np.fromiter(count_tokens(texts, path), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n), pa.array(n > limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key), whole.alias("__text"), F.octet_length(whole).cast("long").alias("__bytes"))
    return rows.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
