"""The numpy part of operator 13: a gated recurrent unit with a class-factored
softmax, trained by truncated backpropagation, over many documents at a time.

A symbol is an output of the model: the ``n_words`` commonest words by themselves,
and behind them one symbol for each bin of rarer words, whose words share it in
fixed proportions. Symbols are dealt into classes; the probability of a symbol is
that of its class given the state, times that of the symbol in its class given the
state. Both softmaxes start from the symbols' counts, so an untrained model is the
unigram model, and what training adds is context.

Documents run in ``streams`` side by side. A stream that has come to the end of its
document takes the next one with a fresh state; otherwise the state is carried
from window to window, so every symbol is predicted from its whole past, while
gradients stop at the window's first symbol.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: The symbol before a document's first.
START = 0
CLIP = 1.0
#: Logits stop here.
MOST = 60.0
TINY = np.float32(1e-30)
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-6
#: More than the arrays of a window together.
KEPT_BYTES = 30 << 20


def _keep_memory() -> None:
    """The C library gives freed memory back to the system beyond twice the largest array
    freed so far (32 MB at the most). Every window would get its arrays anew, page by page,
    which takes a quarter of the time; this one is never written to, so it takes no memory."""
    np.empty(KEPT_BYTES, dtype=np.uint8)


@dataclass
class Shape:
    """Sizes of a model. ``first``: the first symbol of each class and the end."""

    hidden: int
    first: np.ndarray

    @property
    def n_symbols(self) -> int:
        return int(self.first[-1])

    @property
    def n_classes(self) -> int:
        return len(self.first) - 1

    def parts(self) -> dict[str, tuple[int, ...]]:
        h, v, c = self.hidden, self.n_symbols, self.n_classes
        return {"embed": (v + 1, h), "wx": (h, 3 * h), "wh": (h, 3 * h), "b": (3 * h,),
                "class_w": (c, h), "class_b": (c,), "word_w": (v, h), "word_b": (v,)}

    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.parts().values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.parts().items():
            n = int(np.prod(shape))
            out[name] = flat[at:at + n].reshape(shape)
            at += n
        return out


def class_bounds(counts: np.ndarray, n_classes: int) -> np.ndarray:
    """First symbols of classes that hold about equal sums of root counts, so that
    common words have small classes. Counts descend; no class is empty."""
    n = len(counts)
    n_classes = min(n_classes, n)
    mass = np.cumsum(np.sqrt(np.maximum(counts, 1e-9)))
    at = np.searchsorted(mass, mass[-1] * np.arange(1, n_classes) / n_classes) + 1
    lowest = np.arange(1, n_classes)
    at = np.minimum(np.maximum(at, lowest), n - n_classes + lowest)
    at = np.maximum.accumulate(at - lowest) + lowest
    return np.concatenate([[0], np.minimum(at, n - n_classes + lowest), [n]]).astype(np.int64)


def initial(shape: Shape, counts: np.ndarray, seed: int) -> np.ndarray:
    """Small random weights; biases are the logarithms of the counts."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(shape.size(), dtype=np.float32)
    p = shape.views(flat)
    for name in ("embed", "wx", "wh"):
        p[name][...] = rng.standard_normal(p[name].shape) * (0.3 if name == "embed" else 1 / np.sqrt(shape.hidden))
    for name in ("class_w", "word_w"):
        p[name][...] = rng.standard_normal(p[name].shape) * 0.05
    counts = np.maximum(counts, 0.5)
    total = np.add.reduceat(counts, shape.first[:-1])
    p["word_b"][...] = np.log(counts / np.repeat(total, np.diff(shape.first)))
    p["class_b"][...] = np.log(total / total.sum())
    return flat


def _weights(h: np.ndarray, w: np.ndarray, b: np.ndarray, bounded: bool) -> np.ndarray:
    """exp(h w' + b). Logits begin as log probabilities; the bound keeps sums finite.
    ``bounded``: none of them can reach it."""
    out = h @ w.T
    out += b
    if not bounded:
        np.minimum(out, MOST, out=out)
    return np.exp(out, out=out)


def _errors(weight: np.ndarray, target: tuple, n: int) -> tuple[np.ndarray, float]:
    """(probabilities less 1 at the targets, over n; the loss) of weights, in place."""
    weight /= weight.sum(axis=1, keepdims=True)
    loss = -float(np.log(np.maximum(weight[target], TINY)).sum())
    weight[target] -= 1
    weight /= n
    return weight, loss


class Recurrent:
    def __init__(self, shape: Shape, flat: np.ndarray) -> None:
        self.shape, self.flat = shape, flat
        self.p = shape.views(flat)
        self.class_of = np.repeat(np.arange(shape.n_classes), np.diff(shape.first))

    def given(self) -> np.ndarray:
        """(3, symbols, hidden): what the symbol before gives to the update gate, the reset
        gate (both with the other sign) and the new state."""
        p, hid = self.p, self.shape.hidden
        out = p["embed"] @ p["wx"] + p["b"]
        np.negative(out[:, :2 * hid], out=out[:, :2 * hid])
        return np.ascontiguousarray(out.reshape(-1, 3, hid).transpose(1, 0, 2))

    def states(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, kept: dict | None = None, given: np.ndarray | None = None) -> np.ndarray:
        """States before each symbol of a window: x (T, B) are the symbols before,
        ``fresh`` marks where a document begins, h is the state before the window.
        ``kept`` gets what the gradient needs; ``given`` may be handed in."""
        hid = self.shape.hidden
        steps, b = x.shape
        given, any_fresh = self.given() if given is None else given, fresh.any(axis=1).tolist()
        gates = np.empty((3, steps, b, hid), dtype=given.dtype)  # a gate's values lie together
        for k in range(3):
            np.take(given[k], x, axis=0, out=gates[k], mode="clip")
        out = np.empty((steps, b, hid), dtype=self.flat.dtype)
        past, turned = (None, None) if kept is None else (np.empty_like(out), np.empty_like(out))
        wh = self.p["wh"].copy()
        np.negative(wh[:, :2 * hid], out=wh[:, :2 * hid])
        u, reset = np.empty((b, 3 * hid), dtype=out.dtype), np.empty((b, hid), dtype=out.dtype)
        to_gates, to_new = u[:, :2 * hid].reshape(b, 2, hid).transpose(1, 0, 2), u[:, 2 * hid:]
        for t in range(steps):
            if any_fresh[t]:
                h = h.copy()
                h[fresh[t]] = 0
            np.matmul(h, wh, out=u)
            zr, n, new = gates[:2, t], gates[2, t], out[t]
            zr += to_gates
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            n += np.multiply(zr[1], to_new, out=reset)
            np.tanh(n, out=n)
            if kept is not None:
                past[t], turned[t] = h, to_new
            np.subtract(h, n, out=new)
            new *= zr[0]
            new += n
            h = new
        if kept is not None:
            kept |= {"past": past, "turned": turned, "gates": gates}
        return out

    def log_probability(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of symbols ``y`` at states ``h``."""
        p, bounded = self.p, self._bounded(h)
        cls = self.class_of[y]
        weight = _weights(h, p["class_w"], p["class_b"], bounded)
        out = np.log(np.maximum(weight[np.arange(len(y)), cls], TINY) / weight.sum(axis=1))
        order, classes = self._by_class(h, y, cls)
        for at, i, j, own, k in classes:
            weight = _weights(own, p["word_w"][i:j], p["word_b"][i:j], bounded)
            out[order[at]] += np.log(np.maximum(weight[k], TINY) / weight.sum(axis=1))
        return out

    def _bounded(self, h: np.ndarray) -> bool:
        """Whether no logit at these states reaches ``MOST``."""
        if not h.size:
            return True
        p, most = self.p, max(float(h.max()), -float(h.min()))
        return all(float((most * np.abs(p[w]).sum(axis=1) + p[b]).max(initial=0)) < MOST - 1 for w, b in (("class_w", "class_b"), ("word_w", "word_b")))

    def _by_class(self, h: np.ndarray, y: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """The rows' order by class, and (slice of the order, first symbol, end, states,
        index of each row's symbol) of each class of several symbols."""
        order = np.argsort(cls.astype(np.uint16), kind="stable")
        bound = np.concatenate([[0], np.cumsum(np.bincount(cls, minlength=self.shape.n_classes))]).tolist()
        first, h, y, row = self.shape.first.tolist(), h[order], y[order].astype(np.int64), np.arange(len(y))
        found = []
        for c in range(self.shape.n_classes):
            a, b, i, j = bound[c], bound[c + 1], first[c], first[c + 1]
            if b > a and j - i > 1:
                found.append((slice(a, b), i, j, h[a:b], (row[:b - a], y[a:b] - i)))
        return order, found

    def step(self, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, live: np.ndarray, h0: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """Gradient of the mean negative log probability over the window's live
        symbols, its value, and the state after the window."""
        p, hid = self.p, self.shape.hidden
        steps, b = x.shape
        kept: dict = {}
        hs = self.states(x, fresh, h0, kept)
        grad = np.zeros_like(self.flat)
        g = self.shape.views(grad)
        at_live = np.flatnonzero(live.ravel())
        n = max(len(at_live), 1)
        h, target = hs.reshape(-1, hid), y.ravel()
        if len(at_live) < len(h):
            h, target = h[at_live], target[at_live]
        cls, bounded = self.class_of[target], self._bounded(h)
        rows = np.arange(len(target))
        prob, loss = _errors(_weights(h, p["class_w"], p["class_b"], bounded), (rows, cls), n)
        g["class_w"][...] = prob.T @ h
        g["class_b"][...] = prob.sum(axis=0)
        order, classes = self._by_class(h, target, cls)
        dh = (prob @ p["class_w"])[order]
        for at, i, j, own, k in classes:
            q, more = _errors(_weights(own, p["word_w"][i:j], p["word_b"][i:j], bounded), k, n)
            loss += more
            g["word_w"][i:j] = q.T @ own
            g["word_b"][i:j] = q.sum(axis=0)
            dh[at] += q @ p["word_w"][i:j]
        out = np.zeros((steps * b, hid), dtype=np.float32)
        out[at_live[order]] = dh
        out = out.reshape(steps, b, hid)
        back = np.zeros((b, hid), dtype=np.float32)
        d_turned = np.empty((steps, b, 3 * hid), dtype=np.float32)
        d_new, by_state = np.empty((steps, b, hid), dtype=np.float32), np.empty((b, hid), dtype=np.float32)
        wh_t, any_fresh = np.ascontiguousarray(p["wh"].T), fresh.any(axis=1).tolist()
        # what each step multiplies the state's gradient with, for the whole window at once
        z, r, m = kept["gates"]
        rest = 1 - z
        to_m = m * m
        np.subtract(1, to_m, out=to_m)
        to_m *= rest
        to_z = kept["past"] - m
        to_z *= z
        to_z *= rest
        to_r = kept["turned"]
        to_r *= r
        to_r *= np.subtract(1, r, out=rest)
        for t in range(steps - 1, -1, -1):
            d, dn, g_t = out[t], d_new[t], d_turned[t]
            d += back
            np.multiply(d, to_m[t], out=dn)
            np.multiply(d, to_z[t], out=g_t[:, :hid])
            np.multiply(dn, to_r[t], out=g_t[:, hid:2 * hid])
            np.multiply(dn, r[t], out=g_t[:, 2 * hid:])
            np.multiply(d, z[t], out=back)
            back += np.matmul(g_t, wh_t, out=by_state) if wh_t.dtype == by_state.dtype else g_t @ wh_t
            if any_fresh[t]:
                back[fresh[t]] = 0
        g["wh"][...] = kept["past"].reshape(-1, hid).T @ d_turned.reshape(-1, 3 * hid)
        symbol = x.ravel()
        order = np.argsort(symbol, kind="stable")  # 16 bits: by radix
        new = np.flatnonzero(np.concatenate([[True], symbol[order][1:] != symbol[order][:-1]]))
        d_turned[:, :, 2 * hid:] = d_new
        d_given = d_turned.reshape(-1, 3 * hid).take(order, axis=0)
        seen, sums = symbol[order][new], np.add.reduceat(d_given, new, axis=0)
        g["b"][...] = sums.sum(axis=0)
        g["wx"][...] = p["embed"][seen].T @ sums
        g["embed"][seen] = sums @ p["wx"].T
        return grad, loss, hs[-1]


class Streams:
    """Documents (arrays of symbols) laid side by side: the longest first, each on the
    stream that is free first. Streams that end last come first, so the live ones
    of a window are always the first columns."""

    def __init__(self, docs: list[np.ndarray], streams: int) -> None:
        size = np.array([len(d) for d in docs], dtype=np.int64)
        order = [i for i in np.argsort(-size, kind="stable").tolist() if size[i]]
        free = [(0, s) for s in range(max(1, min(streams, len(order))))]
        placed: list[list[tuple[int, int]]] = [[] for _ in free]
        for i in order:
            at, s = free[0]
            placed[s].append((at, i))
            heapq.heapreplace(free, (at + int(size[i]), s))
        ends = {s: at for at, s in free}
        columns = sorted(ends, key=lambda s: (-ends[s], s))
        self.length = np.array([ends[s] for s in columns])
        steps, width = int(self.length[0]), len(columns)
        self.before = np.zeros((steps, width), dtype="<u2")
        self.symbol = np.zeros((steps, width), dtype="<u2")
        self.owner = np.full((steps, width), -1, dtype=np.int32)
        self.fresh = np.zeros((steps, width), dtype=bool)
        for column, s in enumerate(columns):
            for at, i in placed[s]:
                d, end = docs[i], at + int(size[i])
                self.symbol[at:end, column] = d
                # the input at a symbol is one more than the symbol before it
                self.before[at, column] = START
                self.before[at + 1:end, column] = d[:-1] + np.uint16(1)
                self.owner[at:end, column] = i
                self.fresh[at, column] = True

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(symbols before, symbols, fresh, owner) of (steps, live streams); the
        owner of a place after a stream's end is -1."""
        for t in range(0, len(self.symbol), steps):
            n = int((self.length > t).sum())
            yield tuple(x[t:t + steps, :n] for x in (self.before, self.symbol, self.fresh, self.owner))


def stretches(docs: list[np.ndarray], length: int) -> list[np.ndarray]:
    """The documents in stretches of at most ``length`` symbols, dealt by a fixed
    shuffle, so that all streams end at about the same time."""
    out = [d[i:i + length] for d in docs for i in range(0, len(d), length)]
    return [out[i] for i in np.random.default_rng(len(out)).permutation(len(out))]


def train(model: Recurrent, docs: list[np.ndarray], streams: int, steps: int, rate: float, stretch: int) -> tuple[float, int]:
    """One pass over all symbols of the documents; (sum of losses, symbols). The
    state is carried along a stretch. A window that has fewer symbols than others,
    as the streams end, moves the parameters by as much less."""
    _keep_memory()
    parts = stretches(docs, stretch)
    streams = max(1, min(streams, len(parts)))
    h = np.zeros((streams, model.shape.hidden), dtype=np.float32)
    first, second, turn = np.zeros_like(model.flat), np.zeros_like(model.flat), 0
    total, n = 0.0, 0
    for x, y, fresh, owner in Streams(parts, streams).windows(steps):
        live = owner >= 0
        grad, loss, h = model.step(x, y, fresh, live, h[:x.shape[1]])
        norm = float(np.sqrt(grad @ grad))
        if norm > CLIP:
            grad *= CLIP / norm
        turn, size = turn + 1, int(live.sum())
        first += np.float32(1 - BETA1) * (grad - first)
        np.square(grad, out=grad)
        second += np.float32(1 - BETA2) * (grad - second)
        scale = rate * np.sqrt(1 - BETA2 ** turn) / (1 - BETA1 ** turn) * size / (streams * steps)
        np.sqrt(second, out=grad)
        grad += EPSILON
        model.flat -= np.float32(scale) * first / grad
        total, n = total + loss, n + size
    return total, n


def score(model: Recurrent, docs: list[np.ndarray], streams: int, steps: int) -> np.ndarray:
    """Natural log probability of each document's symbols."""
    _keep_memory()
    h = np.zeros((streams, model.shape.hidden), dtype=np.float32)
    out, given = np.zeros(len(docs)), model.given()
    for x, y, fresh, owner in Streams(docs, streams).windows(steps):
        hs = model.states(x, fresh, h[:x.shape[1]], given=given)
        h = hs[-1]
        at = np.flatnonzero(owner.ravel() >= 0)
        log = model.log_probability(hs.reshape(-1, model.shape.hidden)[at], y.ravel()[at])
        out += np.bincount(owner.ravel()[at], weights=log, minlength=len(docs))
    return out
