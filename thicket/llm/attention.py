"""A small causal self-attention language model in numpy.

The next subword id is predicted as a class, from one causal attention layer over a
window of ids, times the id's share of its class. Frequent ids are classes of their own;
the others are grouped by the ids they follow, and those that training documents don't have
are a class of their own, whose probability is add-one's. Texts are scored in overlapping windows of
WINDOW places, of which the last STRIDE are scored, so that each id is scored once, with at least
LEAD places before it where its text has them; before a text's first id, places are masked.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

#: Vocabulary of the tokenizer; its last id stands for the start and the end of a text.
VOCAB = 50257
END = VOCAB - 1
WINDOW, STRIDE = 32, 26
LEAD = WINDOW - STRIDE
SINGLE, GROUPS = 48, 48
#: Class of the ids that no training document has, and the number of ids whose followers are counted.
UNSEEN, COLUMNS = SINGLE + GROUPS, 256
_OUTSIDE = 65535
#: Scored places whose classes are looked at together, so that what is made of them stays in a processor's cache.
BLOCK = 20 * STRIDE


@dataclass
class Model:
    parts: dict[str, np.ndarray]
    class_of: np.ndarray
    unseen: float  # probability of the unseen class
    squares: np.ndarray  # sums of squared gradients of the embedding


def many_windows(sizes: np.ndarray) -> np.ndarray:
    return -(-sizes // STRIDE)


def windows(first: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
    """For texts at first[i]:first[i + 1] the places of each (or each chosen) window's ids (-1: none); the last STRIDE are scored."""
    sizes = np.diff(first)
    many = many_windows(sizes)
    text = np.repeat(np.arange(len(sizes)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    if chosen is not None:
        text, nth = text[chosen], nth[chosen]
    at = (nth * STRIDE - LEAD + first[text])[:, None] + np.arange(WINDOW)
    at[nth == 0, :LEAD] = -1
    last = np.flatnonzero(nth == many[text] - 1)
    ends = at[last]
    ends[ends >= first[text[last] + 1][:, None]] = -1
    at[last] = ends
    return at


#: The places that each scored one looks at.
_CAUSAL = np.tri(STRIDE, WINDOW, LEAD, dtype=np.float32)


class Room:
    """Arrays that are used again for each batch, by name."""

    def __init__(self) -> None:
        self.arrays: dict[str, np.ndarray] = {}

    def of(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.arrays or self.arrays[name].size < size:
            self.arrays[name] = np.empty(size, np.float32)
        return self.arrays[name][:size].reshape(shape)


def forward(p: dict[str, np.ndarray], ids: np.ndarray, begins: np.ndarray, room: Room) -> tuple[np.ndarray, ...]:
    """Hidden states of the scored places of windows of ids (batch, WINDOW), and what the gradient needs. The arrays are room's.

    Windows that begin a text have nothing in their first LEAD places. Queries meet inputs by the product of the query's and
    the key's weights, and weighted inputs go out by that of the value's and the output's, so that there are no keys or values.
    """
    b, d = len(ids), p["embed"].shape[1]
    look, mix = folded(p)
    x = np.take(p["embed"], ids, axis=0, out=room.of("x", b, WINDOW, d), mode="clip")
    x += p["place"]
    own, across = room.of("own", b * STRIDE, d), room.of("across", b, d, WINDOW)
    np.copyto(own.reshape(b, STRIDE, d), x[:, LEAD:])
    np.copyto(across, x.transpose(0, 2, 1))
    q = np.matmul(own, look, out=room.of("q", b * STRIDE, d))
    a = np.matmul(q.reshape(b, STRIDE, d), across, out=room.of("a", b, STRIDE, WINDOW))
    if a.max(initial=0) > 60:
        np.minimum(a, 60, out=a)
    np.exp(a, out=a)
    a *= _CAUSAL
    a[begins, :, :LEAD] = 0
    weight = 1 / (a.reshape(-1, WINDOW) @ np.ones((WINDOW, 1), np.float32))
    y = np.matmul(a, x, out=room.of("y", b, STRIDE, d)).reshape(-1, d)
    y *= weight
    h = np.matmul(y, mix, out=room.of("h", b * STRIDE, d))
    h += own
    t, g = room.of("t", len(h), p["up"].shape[1]), room.of("g", len(h), d)
    for i in range(0, len(h), BLOCK):
        at = slice(i, i + BLOCK)
        np.maximum(np.matmul(h[at], p["up"], out=t[at]), 0, out=t[at])
        np.matmul(t[at], p["down"], out=g[at])
    g += h
    return g.reshape(b, STRIDE, d), x, own, across, q, a, weight, y, h, t


def folded(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The product of the query's weights, scaled, and the key's, and that of the value's and the output's."""
    d = len(p["out"])
    query, key, value = p["qkv"][:, :d], p["qkv"][:, d : 2 * d], p["qkv"][:, 2 * d :]
    return query @ key.T * np.float32(d**-0.5), value @ p["out"]


def _longest(rows: np.ndarray) -> float:
    """The length of the longest row."""
    return math.sqrt(((rows * rows) @ np.ones(rows.shape[1], np.float32)).max(initial=0))


def score(model: Model, ids: np.ndarray, first: np.ndarray, share_logs: np.ndarray, batch: int = 80) -> np.ndarray:
    """Natural log probability of each text; ids are those of all texts, each with its end id."""
    before, places = befores(ids, first), windows(first)
    own = model.class_of[ids]
    logs = np.zeros(len(ids))
    p, room = model.parts, Room()
    d, n = p["classes"].shape
    often, longest = np.exp(p["bias"]), _longest(p["classes"].T)
    lines, z = np.arange(0, n * BLOCK, n), room.of("z", BLOCK, n)
    log_new, log_known = (np.log(model.unseen) if model.unseen else -np.inf), np.log1p(-model.unseen) if model.unseen < 1 else -np.inf
    for i in range(0, len(places), batch):
        at = places[i : i + batch]
        g = forward(p, before[at], at[:, 0] < 0, room)[0].reshape(-1, d)
        large = _longest(g) * longest > 60
        target = at[:, LEAD:].ravel()
        known = np.minimum(own[target], n - 1)
        right, total = np.empty(len(g), np.float32), np.empty(len(g), np.float32)
        for j in range(0, len(g), BLOCK):
            rows = slice(j, j + BLOCK)
            part = np.matmul(g[rows], p["classes"], out=z[: len(g) - j])
            if large:
                np.clip(part, -60, 60, out=part)
            np.take(part.reshape(-1), known[rows] + lines[: len(part)], out=right[rows], mode="clip")
            np.matmul(np.exp(part, out=part), often, out=total[rows])
        found = right + p["bias"][known] - np.log(total) + log_known
        if target.min(initial=0) < 0:
            found, target = found[target >= 0], target[target >= 0]
        logs[target] = found
    logs[own == UNSEEN] = log_new
    logs += share_logs[ids]
    return np.bincount(np.repeat(np.arange(len(first) - 1), np.diff(first)), logs, len(first) - 1)


def shares(class_of: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log of each id's share of its class, one added to each count."""
    n = counts + 1.0
    return np.log(n / np.bincount(class_of, n)[class_of])


def columns(counts: np.ndarray) -> np.ndarray:
    """Place of each of the most frequent ids, -1 for the others."""
    column = np.full(VOCAB, -1)
    column[np.argsort(-counts, kind="stable")[:COLUMNS]] = np.arange(COLUMNS)
    return column


def befores(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The id before each id; the end before the first of a text."""
    before = np.roll(ids, 1)
    before[first[:-1][np.diff(first) > 0]] = END
    return before


def contexts(ids: np.ndarray, first: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (id * COLUMNS + place of the id before it) and how often each occurs."""
    at = column[befores(ids, first)]
    return np.unique(ids[at >= 0] * COLUMNS + at[at >= 0], return_counts=True)


def classes(counts: np.ndarray, cells: np.ndarray, often: np.ndarray, seed: int = 3) -> np.ndarray:
    """Class of each id: the most frequent ones alone, the others by k-means over what they follow."""
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    class_of = np.full(VOCAB, UNSEEN)
    class_of[order[:SINGLE]] = np.arange(len(order[:SINGLE]))
    rest = order[SINGLE:]
    if not len(rest):
        return class_of
    row = np.full(VOCAB, -1)
    row[rest] = np.arange(len(rest))
    at = row[cells // COLUMNS]
    table = np.zeros((len(rest), COLUMNS), np.float32)
    table[at[at >= 0], cells[at >= 0] % COLUMNS] = often[at >= 0]
    total = table.sum(0, keepdims=True) / max(1.0, float(table.sum()))
    sums = table.sum(1, keepdims=True) + 4
    table += 4 * total  # few sightings lean on the whole
    table /= sums
    np.sqrt(table, out=table)
    rng = np.random.default_rng(seed)
    centres = table[rng.permutation(len(rest))[:GROUPS]]
    for _ in range(8):
        near = (table @ centres.T - (centres**2).sum(1) / 2).argmax(1)
        for g in range(len(centres)):
            if (near == g).any():
                centres[g] = table[near == g].mean(0)
    class_of[rest] = SINGLE + near
    return class_of


def sequences(ids: np.ndarray, first: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
    """Windows as rows of 16-bit numbers: the ids before each place, and the last place's own id."""
    places, before = windows(first, chosen), befores(ids, first)
    out = np.full((len(places), WINDOW + 1), _OUTSIDE, np.uint16)
    if len(places):
        out[:, :-1] = np.where(places >= 0, before[places], _OUTSIDE)
        out[:, 1:] = np.where(places >= 0, ids[places], _OUTSIDE)
        out[:, LEAD] = before[places[:, LEAD]]
    return out


def start(class_of: np.ndarray, counts: np.ndarray, d: int = 16, hidden: int = 32, seed: int = 3) -> Model:
    """A model that knows the classes' frequencies alone."""
    rng, n = np.random.default_rng(seed), SINGLE + GROUPS
    shape = {"embed": (VOCAB, d), "place": (WINDOW, d), "qkv": (d, 3 * d), "out": (d, d), "up": (d, hidden), "down": (hidden, d), "classes": (d, n)}
    p = {k: (rng.standard_normal(s) * (0.3 if k == "embed" else s[0] ** -0.5 * 0.5)).astype(np.float32) for k, s in shape.items()}
    share = np.bincount(class_of, counts, UNSEEN + 1)[:n]
    p["bias"] = np.log((share + 1) / (share + 1).sum()).astype(np.float32)
    return Model(p, class_of, 1 / (counts.sum() + 1), np.zeros((VOCAB, d), np.float32))


def fit(model: Model, rows: np.ndarray, picks: Iterable[np.ndarray], steps: int, rate: float) -> np.ndarray:
    """Change the model by one step of Adam for each pick of rows; how often each id was used."""
    p, class_of = model.parts, model.class_of
    (d, n), used = p["classes"].shape, np.zeros(VOCAB, np.int64)
    whole, parts = _in_one({k: x for k, x in p.items() if k != "embed"})
    p |= parts
    slopes, grad = _in_one(parts)
    m, s = np.zeros_like(whole), np.zeros_like(whole)
    room, scale = Room(), np.float32(d**-0.5)
    z, seen, above = room.of("z", BLOCK, n), room.of("seen", BLOCK, d + 1), room.of("above", BLOCK, p["up"].shape[1])
    of_classes = np.zeros((d + 1, n), np.float32)  # the last line is the bias's
    query, key, value = p["qkv"][:, :d], p["qkv"][:, d : 2 * d], p["qkv"][:, 2 * d :]
    for step, pick in enumerate(picks, 1):
        ids = np.take(rows, pick, axis=0)
        into, aim = np.minimum(ids[:, :-1], END), ids[:, LEAD + 1 :].ravel()
        target = np.take(class_of, aim, mode="clip")
        mine = ((aim != _OUTSIDE) & (target != UNSEEN)).astype(np.float32)
        if not mine.any():
            continue
        mine /= mine.sum()
        target = np.minimum(target, n - 1)
        cell = target + np.arange(0, n * BLOCK, n)[np.arange(len(target)) % BLOCK]
        b = len(ids)
        g, x, own, across, q, a, weight, y, h, t = forward(p, into.astype(np.int64), ids[:, 0] == _OUTSIDE, room)
        g = g.reshape(-1, d)
        slopes[:] = of_classes[:] = 0
        back, up_back, down_back = p["classes"].T.copy(), p["up"].T.copy(), p["down"].T.copy()
        large = _longest(g) * _longest(p["classes"].T) + np.abs(p["bias"]).max() > 60
        dh = room.of("dh", len(g), d)
        for i in range(0, len(g), BLOCK):
            at = slice(i, i + BLOCK)
            e = np.matmul(g[at], p["classes"], out=z[: len(g) - i])
            e += p["bias"]
            if large:
                np.clip(e, -60, 60, out=e)
            np.exp(e, out=e)
            total = e @ np.ones(n, np.float32)
            e *= (mine[at] / total)[:, None]
            e.reshape(-1)[cell[at]] -= mine[at]
            seen[: len(e), :d] = g[at]
            seen[: len(e), d] = 1
            of_classes += seen[: len(e)].T @ e
            flat = np.matmul(e, back, out=dh[at])
            grad["down"] += t[at].T @ flat
            dt = flat @ down_back
            up = np.minimum(t[at], 1, out=above[: len(e)])
            dt *= np.ceil(up, out=up)  # 1 where t is above 0
            grad["up"] += h[at].T @ dt
            flat += dt @ up_back
        grad["classes"][:], grad["bias"][:] = of_classes[:d], of_classes[d]
        look, mix = folded(p)
        to_mix = y.T @ dh
        dy = np.matmul(dh, mix.T, out=room.of("dy", len(g), d))
        inner = ((dy * y) @ np.ones((d, 1), np.float32)) * weight
        dy *= weight
        da = np.matmul(dy.reshape(b, STRIDE, d), across, out=room.of("da", *a.shape))
        da -= inner.reshape(b, STRIDE, 1)
        da *= a  # of the scaled products
        dq = np.matmul(da, x, out=room.of("dq", b, STRIDE, d)).reshape(-1, d)
        dx = np.matmul(da.transpose(0, 2, 1), q.reshape(b, STRIDE, d), out=room.of("dx", b, WINDOW, d))
        dx += np.matmul(a.transpose(0, 2, 1), dy.reshape(b, STRIDE, d), out=room.of("dx2", b, WINDOW, d))
        to_look = own.T @ dq * scale
        dh += dq @ look.T
        dx[:, LEAD:] += dh.reshape(b, STRIDE, d)
        for i, x in enumerate((to_look @ key, to_look.T @ query, to_mix @ p["out"].T)):
            grad["qkv"][:, i * d : i * d + d] = x
        grad["out"][:] = value.T @ to_mix
        grad["place"][:] = dx.sum(0)
        now = rate * min(1.0, step / 30) * (1 - 0.9 * step / steps)
        m += 0.1 * (slopes - m)
        s += 0.01 * (slopes * slopes - s)
        whole -= now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
        order = np.argsort(into, None, kind="stable")
        ordered = into.ravel()[order]
        begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        found = ordered[begin].astype(np.int64)
        gr = np.add.reduceat(np.take(dx.reshape(-1, d), order, axis=0), begin, axis=0)
        squares = np.take(model.squares, found, axis=0) + gr * gr  # rare ids get larger steps
        model.squares[found] = squares
        p["embed"][found] = np.take(p["embed"], found, axis=0) - 10 * now * gr / (np.sqrt(squares) + 1e-6)
        used[found] += np.concatenate([begin[1:], [len(ordered)]]) - begin
    return used


def _in_one(parts: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Copies of the arrays one after the other, and the view of each."""
    whole = np.concatenate([x.ravel() for x in parts.values()])
    ends = np.cumsum([x.size for x in parts.values()]).tolist()
    return whole, {k: whole[end - x.size : end].reshape(x.shape) for (k, x), end in zip(parts.items(), ends, strict=True)}
