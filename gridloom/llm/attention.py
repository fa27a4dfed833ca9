"""A small causal self-attention language model over subword ids, in numpy.

A text is read in windows that overlap by their context: each window has `context` ids that are only
looked at and `stride` ids whose successors are scored, so every id is scored once and sees at least
`context` ids before it, its text permitting. All windows of a batch go through one masked attention. The
next id is predicted along a Huffman tree over the vocabulary: a product of yes-or-no choices that sums to
one over all ids. Each choice starts from the odds of the corpus counts, so that the untrained model is the
smoothed unigram model; attention moves the odds of the upper choices.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Shape:
    """Sizes of the model; none depends on the corpus. Rows and choices are numbered in 16 bits."""

    width: int = 16
    context: int = 64
    stride: int = 64
    own_rows: int = 4096
    shared_rows: int = 512
    choices: int = 512
    upper: int = 64
    #: Places for learned choices on a path, at least; a tree takes as many as its longest path needs.
    upper_levels: int = 7
    lower_levels: int = 4


#: Odds of the choice that fills up short paths.
CERTAIN = 1e4
#: Scores are held below this, whose exponential a 32-bit sum still holds.
LARGEST = np.float32(60)
#: Choices whose odds are multiplied at once, each below e^50 + 1.
LEVELS_AT_ONCE = 14
TINY = np.float32(1e-30)
#: Windows whose attention is made together, so that its arrays stay in a core's cache. Windows do not mix, so the number changes no result.
WINDOWS_AT_ONCE = 8


class Huffman:
    """Paths of a Huffman tree over ids with the given weights."""

    def __init__(self, weights: np.ndarray, shape: Shape) -> None:
        n = len(weights)
        heap = [(float(w), i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        total = np.r_[weights.astype(float), np.zeros(n - 1)]
        parent, side = np.full(2 * n - 1, -1), np.zeros(2 * n - 1, np.int8)
        for node in range(n, 2 * n - 1):
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x] = parent[y] = node
            side[y] = 1
            total[node] = a + b
            heapq.heappush(heap, (a + b, node))
        # inner nodes from the root down, by weight: the heaviest choices get vectors
        inner = np.argsort(-total[n:], kind="stable") + n
        rank = np.full(2 * n - 1, -1)
        rank[inner] = np.arange(n - 1)
        # learned choices on the path to each inner node; parents are heavier than their children, so they come first
        depth = np.zeros((2, 2 * n - 1), np.int64)
        for r, node in enumerate(inner[: shape.choices].tolist()):
            if parent[node] >= 0:
                depth[:, node] = depth[:, parent[node]]
            depth[int(r >= shape.upper), node] += 1
        self.upper_levels, lower_levels = (max(int(d.max()), least) for d, least in zip(depth, (shape.upper_levels, shape.lower_levels)))
        # the upper choices come first, then the lower ones; free places hold a choice without alternative, number `upper`
        levels = self.upper_levels + lower_levels
        self.node = np.full((n, levels), shape.upper, np.int32)
        self.sign = np.ones((n, levels), np.float32)
        self.rest = np.zeros(n)
        odds = np.zeros(n - 1)
        first = np.full(2 * n - 1, 0.0)
        child = np.arange(2 * n - 2)
        ones = side[: 2 * n - 2] == 1
        first[parent[child[ones]]] = total[child[ones]]
        share = first[inner] / total[inner]
        odds[:] = np.log(share / (1 - share))
        used = np.stack([np.zeros(n, np.int64), np.full(n, self.upper_levels)])
        at = np.arange(n)
        while True:
            up = parent[at]
            alive = up >= 0
            if not alive.any():
                break
            ids = np.flatnonzero(alive)
            r, s = rank[up[ids]], side[at[ids]]
            half = (r >= shape.upper).astype(np.int64)
            learned = r < shape.choices
            where, h = ids[learned], half[learned]
            self.node[where, used[h, where]] = r[learned] + h
            self.sign[where, used[h, where]] = 2.0 * s[learned] - 1
            used[h, where] += 1
            low = ids[~learned]
            signed = (2.0 * s[~learned] - 1) * odds[r[~learned]]
            self.rest[low] -= np.log1p(np.exp(-signed))
            at = np.where(alive, np.where(alive, up, 0), at)
            at[~alive] = at[~alive]
        self.odds = np.full(shape.choices + 1, CERTAIN, np.float32)
        kept = odds[: shape.choices]
        self.odds[: min(len(kept), shape.upper)] = kept[: shape.upper]
        self.odds[shape.upper + 1 : 1 + len(kept)] = kept[shape.upper :]
        self.rest = self.rest.astype(np.float32)


class Model:
    """Parameters, by table: rows of the last id, queries, keys, values; distances; choices."""

    TABLES = ("last", "query", "key", "value", "near", "choice", "odds")

    def __init__(self, counts: np.ndarray, shape: Shape = Shape(), parameters: dict[str, np.ndarray] | None = None) -> None:
        """`counts` of every id; the last id stands for both the begin and the end of a text."""
        self.shape = shape
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(len(counts))
        self.row = np.where(rank < shape.own_rows, rank, shape.own_rows + (rank * 40503 & 0xFFFF) % shape.shared_rows).astype(np.int32)
        self.row[-1] = min(self.row[-1], shape.own_rows - 1) if rank[-1] < shape.own_rows else 0
        self.tree = Huffman(counts + 0.5, shape)
        self.p = parameters or self._fresh()

    def _fresh(self) -> dict[str, np.ndarray]:
        draw, s = np.random.default_rng(5), self.shape
        rows = s.own_rows + s.shared_rows
        table = lambda scale: (draw.standard_normal((rows, s.width)) * scale).astype(np.float32)
        near = -np.log1p(np.arange(s.context + s.stride, dtype=np.float32))
        return {
            "last": table(0.3),
            "query": table(0.1),
            "key": table(0.1),
            "value": table(0.3),
            "near": near,
            "choice": np.zeros((s.choices + 1, s.width), np.float32),
            "odds": self.tree.odds.copy(),
        }

    def windows(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first scored place, text) of each window. `ids` holds texts in a row, each a begin mark and its ids;
        `ends` is where each text ends."""
        begin = np.r_[0, ends[:-1]]
        n = -(-(ends - begin) // self.shape.stride)
        text = np.repeat(np.arange(len(ends)), n)
        at = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        return begin[text] + at * self.shape.stride, text

    def _attend(self, rows: np.ndarray, start: np.ndarray, begin: np.ndarray, end: np.ndarray, attention: bool = False) -> dict[str, np.ndarray]:
        s, p = self.shape, self.p
        keys_at = start[:, None] + np.arange(-s.context, s.stride)
        usable = (keys_at >= begin[:, None]) & (keys_at < end[:, None])
        row = rows.take(np.where(usable, keys_at, begin[:, None]))
        own = row[:, s.context :]
        # `take` copies whole rows, several times as fast as an index in brackets
        q, k, v = p["query"].take(own, 0), p["key"].take(row, 0), p["value"].take(row, 0)
        apart = np.arange(s.stride)[:, None] + s.context - np.arange(s.context + s.stride)[None, :]
        bias = np.where(apart >= 0, p["near"].take(np.maximum(apart, 0)), np.float32(-1e9)).astype(np.float32)
        edge = ~usable.all(1)  # only the first and last windows of a text
        shut, tiny = np.where(usable, np.float32(0), np.float32(-1e9))[:, None, :], np.where(edge, TINY, np.float32(0))[:, None]
        weights = np.empty((len(start) if attention else min(len(start), WINDOWS_AT_ONCE), s.stride, s.context + s.stride), np.float32)
        h = np.empty(q.shape, np.float32)
        for lo in range(0, len(start), WINDOWS_AT_ONCE):
            some = slice(lo, min(lo + WINDOWS_AT_ONCE, len(start)))
            score = weights[some] if attention else weights[: some.stop - lo]
            np.matmul(q[some], k[some].transpose(0, 2, 1), out=score)
            score += bias  # the causal mask and the distances
            on_edge = edge[some].any()
            if on_edge:
                score += shut[some]
            if score.max() > LARGEST:
                np.minimum(score, LARGEST, out=score)
            np.exp(score, out=score)
            if on_edge:
                score[:, :, s.context] += tiny[some]  # a place behind the end of its text sees something, too
            total = score.sum(2, keepdims=True)
            np.matmul(score, v[some], out=h[some])
            h[some] /= total
            if attention:
                score /= total
        h += p["last"].take(own, 0)
        h /= 1 + np.abs(h)
        return {"row": row, "own": own, "q": q, "k": k, "v": v, "attention": weights, "h": h, "apart": apart}

    def log_probabilities(self, ids: np.ndarray, ends: np.ndarray, at_once: int = 128) -> np.ndarray:
        """Natural log probability of the id after each place of `ids`; the end mark follows a text's last place."""
        begin = np.r_[0, ends[:-1]]
        start, text = self.windows(ids, ends)
        rows = self.row.take(ids)
        follow = np.r_[ids[1:], 0]
        follow[ends - 1] = len(self.row) - 1
        out = np.zeros(len(ids), np.float32)
        steps = np.arange(self.shape.stride)
        node, sign, rest = self.tree.node, self.tree.sign, self.tree.rest
        choice, odds = self.p["choice"], self.p["odds"]
        u, k = self.shape.upper, self.tree.upper_levels
        for lo in range(0, len(start), at_once):
            first, of = start[lo : lo + at_once], text[lo : lo + at_once]
            h = self._attend(rows, first, begin[of], ends[of])["h"]
            place = first[:, None] + steps
            scored = place < ends[of][:, None]
            place, h = (place.reshape(-1), h.reshape(-1, h.shape[2])) if scored.all() else (place[scored], h[scored])
            target = follow.take(place)
            path, turn = node.take(target, 0), sign.take(target, 0)
            z = np.empty(path.shape, np.float32)
            every = h @ choice[: u + 1].T  # the upper choices of all places at once
            z[:, :k] = every.reshape(-1).take(path[:, :k] + np.arange(len(h), dtype=np.int32)[:, None] * (u + 1))
            np.einsum("tld,td->tl", choice.take(path[:, k:], 0), h, out=z[:, k:])
            z += odds.take(path)
            z *= -turn
            np.minimum(z, np.float32(50), out=z)
            np.exp(z, out=z)
            z += 1
            out[place] = rest.take(target) - sum(np.log(_product(z[:, at : at + LEVELS_AT_ONCE])) for at in range(0, z.shape[1], LEVELS_AT_ONCE))
        return out

    def train(self, ids: np.ndarray, ends: np.ndarray, chosen: np.ndarray, memory: dict[str, np.ndarray], rate: float = 0.08, at_once: int = 64) -> None:
        """Adagrad steps on the windows `chosen` (numbers of `windows`)."""
        begin = np.r_[0, ends[:-1]]
        start, text = self.windows(ids, ends)
        rows = self.row.take(ids)
        follow = np.r_[ids[1:], 0]
        follow[ends - 1] = len(self.row) - 1
        for lo in range(0, len(chosen), at_once):
            w = chosen[lo : lo + at_once]
            self._step(rows, follow, start[w], begin[text[w]], ends[text[w]], memory, rate)

    def _step(self, rows, follow, first, begin, end, memory, rate) -> None:  # noqa: ANN001
        s, p = self.shape, self.p
        f = self._attend(rows, first, begin, end, attention=True)
        place = first[:, None] + np.arange(s.stride)
        scored = (place < end[:, None]).reshape(-1)
        target = follow.take(np.where(scored, place.reshape(-1), 0))
        path, turn = self.tree.node.take(target, 0), self.tree.sign.take(target, 0) * scored[:, None]
        h, u, k = f["h"].reshape(-1, s.width), s.upper, self.tree.upper_levels
        # The upper choices of all places are one product, and so is what they add to each choice; free places add nothing.
        upper, at = p["choice"][: u + 1], path[:, :k] + np.arange(len(h), dtype=np.int32)[:, None] * (u + 1)
        every = h @ upper.T
        lower = p["choice"].take(path[:, k:], 0)
        z = np.concatenate([every.reshape(-1).take(at), np.einsum("tld,td->tl", lower, h)], 1) + p["odds"].take(path)
        dz = turn / (1 + np.exp(np.clip(turn * z, -30, 30)))
        low = dz[:, k:].reshape(-1)
        moved = np.zeros_like(every)
        moved.reshape(-1)[at] = dz[:, :k]
        dh = (moved @ upper + np.einsum("tl,tld->td", dz[:, k:], lower)) * (1 - np.abs(h)) ** 2
        dodds = np.bincount(path[:, k:].reshape(-1), low, len(p["odds"])).astype(np.float32)
        dodds[: u + 1] += moved.sum(0)
        dh = dh.reshape(f["h"].shape)
        a = f["attention"]
        ds, dq, dk, dv = np.empty_like(a), np.empty_like(f["q"]), np.empty_like(f["k"]), np.empty_like(f["v"])
        for lo in range(0, len(a), WINDOWS_AT_ONCE):
            some = slice(lo, lo + WINDOWS_AT_ONCE)
            now, seen = ds[some], a[some]
            np.matmul(dh[some], f["v"][some].transpose(0, 2, 1), out=now)
            now -= np.einsum("bsk,bsk->bs", now, seen)[:, :, None]
            now *= seen
            np.matmul(now, f["k"][some], out=dq[some])
            np.matmul(now.transpose(0, 2, 1), f["q"][some], out=dk[some])
            np.matmul(seen.transpose(0, 2, 1), dh[some], out=dv[some])
        keep = f["apart"] >= 0
        dnear = np.bincount(f["apart"][keep], ds.sum(0)[keep], len(p["near"])).astype(np.float32)
        # Of the places for lower choices, those that hold one: more than half are free.
        lower_at, levels = path[:, k:].reshape(-1), path.shape[1] - k
        held = np.flatnonzero(lower_at != u)
        dlower = h.take(held // levels, 0) * low.take(held)[:, None]
        grown = [
            (("choice",), lower_at.take(held), [dlower]),
            (("last", "query"), f["own"].reshape(-1), [dh.reshape(-1, s.width), dq.reshape(-1, s.width)]),
            (("key", "value"), f["row"].reshape(-1), [dk.reshape(-1, s.width), dv.reshape(-1, s.width)]),
        ]
        sums = {"choice": moved.T @ h}
        for names, at, changes in grown:
            order = np.argsort(at.astype(np.uint16), kind="stable")  # 16 bits are sorted by counting
            at = at.take(order)
            lead = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])  # none where no place has a lower choice
            one = at.take(lead)
            for name, change in zip(names, changes):
                total = np.add.reduceat(change.take(order, 0), lead, 0)
                if name in sums:
                    sums[name], whole = np.zeros_like(p[name]), sums[name]
                    sums[name][: len(whole)] = whole
                    sums[name][one] += total
                    memory[name] += sums[name] ** 2
                    p[name] += rate * sums[name] / np.sqrt(memory[name] + 1e-6)
                else:
                    squares = memory[name].take(one, 0) + total**2
                    memory[name][one] = squares
                    p[name][one] = p[name].take(one, 0) + rate * total / np.sqrt(squares + 1e-6)
        for name, total in (("odds", dodds), ("near", dnear)):
            memory[name] += total**2
            p[name] += 0.3 * rate * total / np.sqrt(memory[name] + 1e-6)

    def memory(self) -> dict[str, np.ndarray]:
        """Empty sums of squares for `train`; their start holds back the first steps."""
        return {name: np.full_like(value, 0.1) for name, value in self.p.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[name].reshape(-1) for name in self.TABLES])

    def unflattened(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name in self.TABLES:
            size = self.p[name].size
            out[name] = flat[at : at + size].reshape(self.p[name].shape).astype(np.float32)
            at += size
        return out


def _product(z: np.ndarray) -> np.ndarray:
    """Products of the rows, column after column, in 64 bits."""
    out = z[:, 0].astype(np.float64)
    for i in range(1, z.shape[1]):
        out *= z[:, i]
    return out


def rows_of_texts(texts: Iterator[np.ndarray], mark: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts in a row, each behind a begin mark, and where each ends."""
    parts, ends, at = [], [], 0
    for ids in texts:
        parts += [np.array([mark]), ids]
        at += len(ids) + 1
        ends.append(at)
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64), np.array(ends, np.int64)
