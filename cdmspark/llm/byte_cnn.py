"""A byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it; overlaps are wider than a
filter, so every window of a text lies whole in some chunk. Bytes are embedded, filters run
over every place of a chunk, and each filter's greatest value in the chunk is kept. A text's
vector holds, per filter, the greatest and the mean of its chunks' values; a hidden layer turns
that into one logit. Gradients flow back only to the places that won, whatever the text's length.
"""

from __future__ import annotations

import numpy as np

WIDTH, DIM, FILTERS, HIDDEN = 8, 8, 24, 16
CHUNK, OVERLAP = 256, 32
#: Symbol behind a text's last byte.
PAD = 256
#: Chunks whose windows are held at once.
SLAB = 256
BATCH, STEPS, RATE, DECAY = 32, 450, 0.005, 1e-4

_SHAPES = {"e": (PAD + 1, DIM), "w": (WIDTH * DIM, FILTERS), "b": (FILTERS,), "v": (2 * FILTERS, HIDDEN), "c": (HIDDEN,),
           "o": (HIDDEN,), "bias": (1,)}


def start(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    scale = {"e": 0.5, "w": (WIDTH * DIM) ** -0.5, "v": (2 * FILTERS) ** -0.5, "o": HIDDEN ** -0.5}
    return {k: (rng.normal(0, scale[k], s) if k in scale else np.zeros(s)).astype(np.float32) for k, s in _SHAPES.items()}


def chunks_of(raw: bytes) -> np.ndarray:
    """Chunks of a text, one a row; a text without bytes has one chunk of padding."""
    hop = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // hop))
    flat = np.full((n - 1) * hop + CHUNK, PAD, np.int16)
    flat[:len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::hop]


def _pooled(p: dict, chunks: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Greatest value of each filter in each chunk and, on request, where it is."""
    best = np.empty((len(chunks), FILTERS), np.float32)
    at = np.zeros((len(chunks), FILTERS), np.int64) if places else None
    for lo in range(0, len(chunks), SLAB):
        own = chunks[lo:lo + SLAB]
        x = p["e"][own].reshape(len(own), -1)
        top = None
        for shift in range(WIDTH):           # windows a width apart lie side by side in memory
            m = (CHUNK - shift) // WIDTH
            z = (x[:, shift * DIM:(shift + m * WIDTH) * DIM].reshape(-1, WIDTH * DIM) @ p["w"]).reshape(len(own), m, FILTERS)
            if places:
                i = z.argmax(1)
                value = np.take_along_axis(z, i[:, None], 1)[:, 0]
                i = i * WIDTH + shift
                if top is None:
                    top, where = value, i
                else:
                    more = value > top
                    top, where = np.where(more, value, top), np.where(more, i, where)
            else:
                value = z.max(1)
                top = value if top is None else np.maximum(top, value)
        best[lo:lo + SLAB] = top
        if places:
            at[lo:lo + SLAB] = where
    return np.maximum(best + p["b"], 0), at


def _vectors(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Greatest and mean of each text's chunk values; ``size`` tells how many chunks each has."""
    first = np.cumsum(size) - size
    return np.concatenate([np.maximum.reduceat(values, first), np.add.reduceat(values, first) / size[:, None]], 1)


def logits(p: dict, texts: list[bytes]) -> np.ndarray:
    """One logit per text; texts are worked through in slabs of chunks, a long one by itself."""
    out, held, size = [], [], []

    def flush():
        hidden = np.maximum(_vectors(_pooled(p, np.concatenate(held))[0], np.array(size)) @ p["v"] + p["c"], 0)
        out.append(hidden @ p["o"] + p["bias"])
        held.clear()
        size.clear()
    for raw in texts:
        own = chunks_of(raw)
        held.append(own)
        size.append(len(own))
        if sum(size) >= 4 * SLAB:
            flush()
    if held:
        flush()
    return np.concatenate(out).astype(np.float64) if out else np.zeros(0)


def gradients(p: dict, chunks: np.ndarray, size: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
    """Mean logistic loss over some texts and its gradients."""
    values, at = _pooled(p, chunks, places=True)
    vector, first = _vectors(values, size), np.cumsum(size) - size
    raw = vector @ p["v"] + p["c"]
    hidden = np.maximum(raw, 0)
    z = hidden @ p["o"] + p["bias"][0]
    loss = float(np.mean(np.logaddexp(0, np.where(label > 0, -z, z))))
    dz = ((1 / (1 + np.exp(-z)) - label) / len(label)).astype(np.float32)
    dh = dz[:, None] * p["o"] * (raw > 0)
    dv = dh @ p["v"].T
    doc = np.repeat(np.arange(len(size)), size)
    # the mean's share for every chunk, the maximum's for the first chunk that has it
    dc = (dv[:, FILTERS:] / size[:, None])[doc]
    is_top = values == vector[doc, :FILTERS]
    order = np.where(is_top, np.arange(len(values))[:, None], len(values))
    winner = np.minimum.reduceat(order, first)
    np.add.at(dc, (winner, np.arange(FILTERS)[None, :]), dv[:, :FILTERS])
    dc *= values > 0
    window = chunks[np.arange(len(chunks))[:, None, None], at[:, :, None] + np.arange(WIDTH)]
    x = p["e"][window].reshape(len(chunks), FILTERS, WIDTH * DIM)
    dw = np.einsum("cf,cfi->if", dc, x)
    share, symbol = (dc[:, :, None] * p["w"].T[None]).reshape(-1, DIM), window.reshape(-1)
    de = np.stack([np.bincount(symbol, x, PAD + 1) for x in share.T], 1).astype(p["e"].dtype)
    return loss, {"e": de, "w": dw, "b": dc.sum(0), "v": vector.T @ dh, "c": dh.sum(0), "o": hidden.T @ dz,
                  "bias": np.array([dz.sum()], np.float32)}


def fit(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 5) -> dict[str, np.ndarray]:
    """Adam over batches that hold as many texts of one label as of the other, if there are both;
    the last quarter of the steps is averaged."""
    p, rng = start(seed), np.random.default_rng(seed)
    kinds = [k for k in (np.flatnonzero(labels == v) for v in (0, 1)) if len(k)]
    (m, v, mean), taken = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(3)), 0
    decks = [np.zeros(0, np.int64) for _ in kinds]
    for step in range(1, steps + 1):
        rows = []
        for i, k in enumerate(kinds):
            need = BATCH // len(kinds)
            while len(decks[i]) < need:
                decks[i] = np.concatenate([decks[i], rng.permutation(k)])
            rows.append(decks[i][:need])
            decks[i] = decks[i][need:]
        rows = np.concatenate(rows)
        own = [chunks_of(texts[i]) for i in rows]
        _, g = gradients(p, np.concatenate(own), np.array([len(x) for x in own]), labels[rows].astype(np.float32))
        rate = RATE * min(1.0, step / 30) * (1 - 0.9 * step / steps)
        for k in p:
            g[k] = g[k] + DECAY * p[k]
            m[k] += 0.1 * (g[k] - m[k])
            v[k] += 0.001 * (g[k] * g[k] - v[k])
            p[k] = p[k] - np.float32(rate) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8).astype(np.float32)
        if step > 0.75 * steps:
            taken += 1
            for k in p:
                mean[k] += (p[k] - mean[k]) / taken
    return {k: x.astype(np.float32) for k, x in (mean if taken else p).items()}
