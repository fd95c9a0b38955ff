"""A small gated recurrent language model in numpy: forward, truncated backpropagation and
Adagrad over many documents at once.

Output is factored: P(word) = P(class | state) * P(word | class, state). The first ``heads``
classes hold ``width`` frequent words each and have a softmax of their own; the others are
tails whose words are shared out by the caller, without regard to the state. Documents lie in
lanes; a lane holds whole documents one after another, its state starts at zero with each, and
is carried from window to window within one.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN, HEADS, WIDTH, TAILS = 12, 16, 48, 48
CLASSES, FREQUENT = HEADS + TAILS, HEADS * WIDTH
INPUTS = FREQUENT + TAILS
LANES, WINDOW = 512, 16
#: What Adagrad takes every squared gradient's sum to be before the first.
FIRST = 1e-4

_SHAPES = {"x": (INPUTS, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,),
           "ww": (HEADS, HIDDEN, WIDTH), "bw": (HEADS, WIDTH)}


def start(class_share: np.ndarray, word_share: np.ndarray) -> dict[str, np.ndarray]:
    """Weights that give the shares of classes, and of words in head classes, at any state."""
    rng = np.random.default_rng(11)
    p = {k: (rng.normal(0, 0.1, s) if k in ("x", "u") else np.zeros(s)).astype(np.float32) for k, s in _SHAPES.items()}
    p["bc"] = np.log(np.maximum(class_share, 1e-9)).astype(np.float32)
    p["bw"] = np.log(np.maximum(word_share, 1e-9)).astype(np.float32)
    return p


def to_bytes(p: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([p[k].ravel() for k in _SHAPES]).astype(np.float32).tobytes()


def from_vector(v: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in _SHAPES.items():
        n = int(np.prod(s))
        out[k] = v[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


@dataclass
class Lanes:
    """Documents (arrays of input ids, the last one the end) dealt to lanes of falling length.

    Step t holds places ``at[t]`` to ``at[t + 1]``, one per lane still in use. ``feed`` is the
    id before, ``want`` the id to predict; ``first`` marks a document's first step; ``doc`` is
    its number. Size is the number of tokens, however uneven the documents."""

    feed: np.ndarray
    want: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    at: np.ndarray

    @staticmethod
    def deal(docs: list[np.ndarray], end: int, lanes: int = LANES) -> Lanes:
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        heap = [(0, k, []) for k in range(min(lanes, len(docs)))]
        for i in order:
            n, k, own = heap[0]
            own.append(i)
            heapq.heapreplace(heap, (n + len(docs[i]), k, own))
        heap.sort(key=lambda x: (-x[0], x[1]))
        length = np.array([x[0] for x in heap])
        live = len(heap) - np.searchsorted(length[::-1], np.arange(length[0]), side="right")
        at = np.concatenate([[0], np.cumsum(live)])
        feed, want, doc = (np.empty(at[-1], np.int32) for _ in range(3))
        first = np.zeros(at[-1], bool)
        for k, (_, _, own) in enumerate(heap):
            t = 0
            for i in own:
                n = len(docs[i])
                places = at[t:t + n] + k
                want[places], doc[places], first[places[0]] = docs[i], i, True
                feed[places[0]], feed[places[1:]] = end, docs[i][:-1]
                t += n
        return Lanes(feed, want, first, doc, at)

    @property
    def steps(self) -> int:
        return len(self.at) - 1

    @property
    def width(self) -> int:
        return int(self.at[1])


def _softmax(a: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row softmax, in place of ``a``, and the log-probability of place ``at`` in each row."""
    np.clip(a, -30, 30, out=a)  # weights keep logits far inside; spares the pass for the maximum
    own = a[np.arange(len(a)), at]
    np.exp(a, out=a)
    total = a @ np.ones(a.shape[1], a.dtype)
    a /= total[:, None]
    return a, own - np.log(total)


def class_of(ids: np.ndarray) -> np.ndarray:
    return np.where(ids < FREQUENT, ids // WIDTH, ids - FREQUENT + HEADS)


def _by_class(cls: np.ndarray):
    """(class, positions) for the head classes present."""
    order = np.argsort(cls, kind="stable")
    cut = np.searchsorted(cls[order], np.arange(HEADS + 1))
    return [(c, order[cut[c]:cut[c + 1]]) for c in range(HEADS) if cut[c + 1] > cut[c]]


def _step(p, a, first, h):
    """New states from ``a``, the inputs' rows of the gates; ``first`` marks new documents (None: there are none)."""
    if first is not None:
        h = np.where(first[:, None], np.float32(0), h)
    g = h @ p["u"]
    zr = a[:, :2 * HIDDEN] + g[:, :2 * HIDDEN]
    np.negative(zr, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
    n = r * g[:, 2 * HIDDEN:]
    n += a[:, 2 * HIDDEN:]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, (h, z, r, n, g[:, 2 * HIDDEN:])


def _log_prob(a: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of place ``at`` in each row of logits ``a``, which is used up."""
    np.clip(a, -30, 30, out=a)
    own = a[np.arange(len(a)), at]
    np.exp(a, out=a)
    return own - np.log(a @ np.ones(a.shape[1], a.dtype))


def _states(p: dict, lanes: Lanes, lo: int, hi: int, h: np.ndarray, kept: list | None = None) -> list[np.ndarray]:
    """States of steps ``lo`` to ``hi``, from ``h`` before them."""
    at, states = lanes.at, []
    base = at[lo]
    a, new = p["x"][lanes.feed[base:at[hi]]], np.logical_or.reduceat(lanes.first[base:at[hi]], at[lo:hi] - base)
    for t, starts in zip(range(lo, hi), new.tolist(), strict=True):
        i, j = at[t], at[t + 1]
        h, memo = _step(p, a[i - base:j - base], lanes.first[i:j] if starts else None, h[:j - i])
        states.append(h)
        if kept is not None:
            kept.append(memo)
    return states


def score(p: dict, lanes: Lanes, n_docs: int, slab: int = 16) -> np.ndarray:
    """Natural log-probability of each document's classes, and words in head classes; classes are
    looked at for as many places at a time as ``slab`` steps of all lanes have."""
    total, h, at = np.zeros(n_docs), np.zeros((lanes.width, HIDDEN), np.float32), lanes.at
    lo = 0
    while lo < lanes.steps:
        hi = min(max(lo + 1, int(np.searchsorted(at, at[lo] + slab * lanes.width, "right")) - 1), lanes.steps)
        states = _states(p, lanes, lo, hi, h)
        h = states[-1]
        s, own = np.concatenate(states), slice(at[lo], at[hi])
        want = lanes.want[own]
        cls = class_of(want)
        lp = _log_prob(s @ p["wc"] + p["bc"], cls)
        for c, rows in _by_class(cls):
            lp[rows] += _log_prob(s[rows] @ p["ww"][c] + p["bw"][c], want[rows] - c * WIDTH)
        total += np.bincount(lanes.doc[own], lp, n_docs)
        lo = hi
    return total


class Trainer:
    """Adagrad over truncated windows; ``loss`` and ``tokens`` tell how it went."""

    def __init__(self, p: dict, rate: float, lanes: int = LANES):
        self.scale = np.float32(1 / (lanes * WINDOW))
        self.p = {k: v.copy() for k, v in p.items()}
        self.seen = {k: np.full_like(v, FIRST) for k, v in p.items()}
        self.rate, self.loss, self.tokens = rate, 0.0, 0

    def _move(self, k: str, grad: np.ndarray, rows=slice(None)) -> None:
        # one scale for all windows, so that windows with few lanes left move little
        grad *= self.scale
        own = self.seen[k][rows] + grad * grad
        self.seen[k][rows] = own
        self.p[k][rows] -= self.rate * grad / np.sqrt(own)

    def run(self, lanes: Lanes) -> None:
        h = np.zeros((lanes.width, HIDDEN), np.float32)
        for lo in range(0, lanes.steps, WINDOW):
            h = self._window(lanes, lo, min(lo + WINDOW, lanes.steps), h)

    def _window(self, lanes: Lanes, lo: int, hi: int, h: np.ndarray) -> np.ndarray:
        p, kept, at = self.p, [], lanes.at
        states = _states(p, lanes, lo, hi, h, kept)
        h = states[-1]
        s, want = np.concatenate(states), lanes.want[at[lo]:at[hi]]
        cls = class_of(want)
        d, lp = _softmax(s @ p["wc"] + p["bc"], cls)
        self.loss -= float(lp.sum())
        d[np.arange(len(s)), cls] -= 1
        ds = d @ p["wc"].T
        heads = []
        for c, own in _by_class(cls):
            so = s[own]
            word = want[own] - c * WIDTH
            e, lw = _softmax(so @ p["ww"][c] + p["bw"][c], word)
            self.loss -= float(lw.sum())
            e[np.arange(len(own)), word] -= 1
            ds[own] += e @ p["ww"][c].T
            heads.append((c, so.T @ e, e.sum(0)))
        # back through the window
        grads, gated, ut = [], [], np.ascontiguousarray(p["u"].T)
        dh = np.zeros((len(states[0]), HIDDEN), np.float32)
        for i in range(hi - lo - 1, -1, -1):
            own = slice(at[lo + i], at[lo + i + 1])
            k, (h0, z, r, n, gn) = len(states[i]), kept[i]
            g = dh[:k] + ds[own.start - at[lo]:own.stop - at[lo]]
            gz = g * z
            dn = (g - gz) * (1 - n * n)
            da = np.empty((k, 3 * HIDDEN), np.float32)
            da[:, :HIDDEN] = gz * (1 - z) * (h0 - n)
            rn = dn * r
            da[:, HIDDEN:2 * HIDDEN] = rn * gn * (1 - r)
            da[:, 2 * HIDDEN:] = rn
            back = da @ ut
            back += gz
            if lanes.first[own].any():
                back[lanes.first[own]] = 0
            dh[:k] = back
            gated.append(da)
            da = da.copy()
            da[:, 2 * HIDDEN:] = dn
            grads.append(da)
        du = np.concatenate([m[0] for m in kept[::-1]]).T @ np.concatenate(gated)
        feed, da = lanes.feed[at[lo]:at[hi]], np.concatenate(grads[::-1])
        order = np.argsort(feed, kind="stable")
        rows, first = np.unique(feed[order], return_index=True)
        self._move("x", np.add.reduceat(da[order], first, axis=0), rows)
        self._move("u", du)
        self._move("wc", s.T @ d)
        self._move("bc", d.sum(0))
        for c, gw, gb in heads:
            self._move("ww", gw, c)
            self._move("bw", gb, c)
        self.tokens += len(s)
        return h
