"""A bidirectional LSTM over sequences of blocks, written with numpy: training by Adam, batched labelling."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """Labels every block of a sequence with the probability of its class.

    A block is a bag of hashed words (rows of an embedding, averaged) and a vector of shape features.
    """

    def __init__(self, buckets: int, shapes: int, words: int = 24, hidden: int = 24, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.hidden, inputs = hidden, words + shapes
        self.p = {"emb": rng.normal(0, 0.1, (buckets, words)).astype(np.float32), "v": rng.normal(0, 0.1, 2 * hidden + inputs).astype(np.float32), "c": np.zeros(1, np.float32)}
        for d in "fb":
            self.p["w" + d] = rng.normal(0, (inputs + hidden) ** -0.5, (inputs + hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.p["o" + d] = bias

    def inputs(self, words: np.ndarray, ends: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """Vectors of blocks; block i has the words up to ``ends[i]``."""
        starts = np.concatenate([[0], ends[:-1]])
        counts = ends - starts
        sums = np.zeros((len(ends), self.p["emb"].shape[1]), np.float32)
        filled = counts > 0
        if len(words):
            step = 1 << 20  # words at a time, to bound memory
            at = np.flatnonzero(filled)
            cut = 0
            while cut < len(at):
                stop = max(cut + 1, int(np.searchsorted(ends[at], starts[at[cut]] + step, "right")))
                rows = at[cut:stop]
                low, high = starts[rows[0]], ends[rows[-1]]
                sums[rows] = np.add.reduceat(self.p["emb"][words[low:high]], starts[rows] - low, axis=0)
                cut = stop
        return np.concatenate([sums / np.maximum(counts, 1)[:, None], shapes], axis=1)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Outputs of one direction for padded sequences ``x`` (time, sequence, input)."""
        h = np.zeros((x.shape[1], self.hidden), np.float32)
        c = np.zeros_like(h)
        n, w, out = self.hidden, self.p["w" + d], np.zeros((x.shape[0], x.shape[1], self.hidden), np.float32)
        fed = x @ w[: x.shape[2]] + self.p["o" + d]
        for t in range(x.shape[0]) if d == "f" else range(x.shape[0] - 1, -1, -1):
            gates = fed[t] + h @ w[x.shape[2] :]
            ifo = _sigmoid(gates[:, : 3 * n])
            g = np.tanh(gates[:, 3 * n :])
            m = mask[t][:, None]
            before = (h, c)
            c = np.where(m, ifo[:, n : 2 * n] * c + ifo[:, :n] * g, c)
            tc = np.tanh(c)
            h = np.where(m, ifo[:, 2 * n :] * tc, h)
            out[t] = h * m
            if keep is not None:
                keep.append((t, *before, ifo, g, tc, m))
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, "f"), self._run(x, mask, "b"), x], axis=2)
        return both @ self.p["v"] + self.p["c"]

    def label(self, x: np.ndarray, sizes: np.ndarray, batch: int = 512) -> np.ndarray:
        """Probabilities of all blocks of sequences with ``sizes`` blocks each, in the given order."""
        out = np.zeros(len(x), np.float32)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        at = 0
        while at < len(order):
            longest = sizes[order[min(at + batch, len(order)) - 1]]
            take = order[at : at + max(1, min(batch, 200_000 // max(1, longest)))]
            steps = np.arange(sizes[take].max())
            mask = steps[:, None] < sizes[take][None]
            rows = np.where(mask, starts[take][None] + steps[:, None], 0)
            out[rows[mask]] = _sigmoid(self.scores(x[rows], mask))[mask]
            at += len(take)
        return out

    def fit(self, words: np.ndarray, ends: np.ndarray, shapes: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 6, batch: int = 48, rate: float = 0.01, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        word_starts = np.concatenate([[0], ends[:-1]])
        for turn in range(rounds):
            order = rng.permutation(np.flatnonzero(sizes > 0))
            order = order[np.argsort(sizes[order] // 4, kind="stable")]
            cuts = [order[i : i + batch] for i in range(0, len(order), batch)]
            for i in rng.permutation(len(cuts)):
                take = cuts[i]
                steps = np.arange(sizes[take].max())
                mask = steps[:, None] < sizes[take][None]
                rows = np.where(mask, starts[take][None] + steps[:, None], 0)
                flat = rows[mask]
                lengths = ends[flat] - word_starts[flat]
                local_ends = np.cumsum(lengths)
                local = words[np.arange(local_ends[-1] if len(flat) else 0) + np.repeat(word_starts[flat] - (local_ends - lengths), lengths)]
                vectors = self.inputs(local, local_ends, shapes[flat])
                x = np.zeros((*rows.shape, vectors.shape[1]), np.float32)
                x[mask] = vectors
                kept: dict[str, list] = {"f": [], "b": []}
                out = {d: self._run(x, mask, d, kept[d]) for d in "fb"}
                both = np.concatenate([out["f"], out["b"], x], axis=2)
                p = _sigmoid(both @ self.p["v"] + self.p["c"])
                target, w = np.zeros(rows.shape, np.float32), np.zeros(rows.shape, np.float32)
                target[mask], w[mask] = y[flat], weight[flat]
                ds = (p - target) * w / max(1.0, w.sum())
                grads = {"v": np.einsum("ts,tsi->i", ds, both), "c": np.array([ds.sum()], np.float32)}
                dboth = ds[:, :, None] * self.p["v"]
                dx = dboth[:, :, 2 * self.hidden :].copy()
                for j, d in enumerate("fb"):
                    dx += self._back(x, kept[d], dboth[:, :, j * self.hidden : (j + 1) * self.hidden], d, grads)
                demb = np.zeros_like(self.p["emb"])
                mean = dx[mask][:, : self.p["emb"].shape[1]] / np.maximum(lengths, 1)[:, None]
                np.add.at(demb, local, np.repeat(mean, lengths, axis=0))
                grads["emb"] = demb
                step += 1
                pace = rate * (0.5 ** (turn / max(1, rounds - 1) * 3))
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.p[k] -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def _back(self, x: np.ndarray, kept: list, dout: np.ndarray, d: str, grads: dict) -> np.ndarray:
        n, size, w = self.hidden, x.shape[2], self.p["w" + d]
        dgates = np.zeros((x.shape[0], x.shape[1], 4 * n), np.float32)
        dh, dc = np.zeros((x.shape[1], n), np.float32), np.zeros((x.shape[1], n), np.float32)
        dw_h = np.zeros((n, 4 * n), np.float32)
        for t, h0, c0, ifo, g, tc, m in reversed(kept):
            dh_now = np.where(m, dh + dout[t], 0)
            i, f, o = ifo[:, :n], ifo[:, n : 2 * n], ifo[:, 2 * n :]
            dc_now = np.where(m, dc + dh_now * o * (1 - tc * tc), 0)
            dg = np.concatenate([dc_now * g * i * (1 - i), dc_now * c0 * f * (1 - f), dh_now * tc * o * (1 - o), dc_now * i * (1 - g * g)], axis=1)
            dgates[t] = dg
            dw_h += h0.T @ dg
            dh = np.where(m, dg @ w[size:].T, dh)
            dc = np.where(m, dc_now * f, dc)
        flat = dgates.reshape(-1, 4 * n)
        grads["w" + d] = np.concatenate([x.reshape(-1, size).T @ flat, dw_h])
        grads["o" + d] = flat.sum(0)
        return (flat @ w[:size].T).reshape(x.shape)
