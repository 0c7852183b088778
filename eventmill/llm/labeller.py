"""A bidirectional LSTM over the blocks of a page, in numpy.

Block vectors pass a tanh layer and two LSTMs, one in each direction; a logistic unit
reads both states at every block, so each label depends on the whole page. Trained by
Adam on the cross entropy with gradients through time.
"""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    def __init__(self, width: int, dense: int = 24, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        make = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        self.hidden = hidden
        self.p = {"W": make(width, dense), "b": np.zeros(dense, np.float32)}
        for d in "fb":
            self.p[f"X{d}"] = make(dense, 4 * hidden)
            self.p[f"H{d}"] = make(hidden, 4 * hidden)
            self.p[f"c{d}"] = np.zeros(4 * hidden, np.float32)
            self.p[f"c{d}"][hidden : 2 * hidden] = 1.0  # remember by default
        self.p["O"] = make(2 * hidden, 1)
        self.p["o"] = np.zeros(1, np.float32)

    def _direction(self, e, mask, d, keep):
        """States of one direction; ``e`` is batch x time x dense."""
        n, steps, h = e.shape[0], e.shape[1], self.hidden
        H = self.p[f"H{d}"]
        z_in = e @ self.p[f"X{d}"] + self.p[f"c{d}"]
        out = np.zeros((n, steps, h), np.float32)
        hs, cs = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        trace = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = z_in[:, t] + hs @ H
            gates = sigmoid(z[:, : 3 * h])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            g = np.tanh(z[:, 3 * h :])
            m = mask[:, t, None]
            c_new = f * cs + i * g
            tc = np.tanh(c_new)
            if keep:
                trace.append((t, hs, cs, i, f, o, g, tc, m))
            hs = m * (o * tc) + (1 - m) * hs
            cs = m * c_new + (1 - m) * cs
            out[:, t] = hs
        return out, trace

    def forward(self, x, mask, keep=False):
        e = np.tanh(x @ self.p["W"] + self.p["b"])
        f, tf = self._direction(e, mask, "f", keep)
        b, tb = self._direction(e, mask, "b", keep)
        s = np.concatenate((f, b), 2)
        y = sigmoid((s @ self.p["O"])[..., 0] + self.p["o"])
        return y, (e, s, tf, tb)

    def _back_direction(self, e, trace, ds, d, grads):
        h, H = self.hidden, self.p[f"H{d}"]
        dz_all = np.zeros((*e.shape[:2], 4 * h), np.float32)
        dh, dc = np.zeros_like(ds[:, 0]), np.zeros_like(ds[:, 0])
        for t, hs, cs, i, f, o, g, tc, m in reversed(trace):
            dh = dh + ds[:, t]
            here = m * dh
            do = here * tc
            dcn = m * dc + here * o * (1 - tc * tc)
            dz = np.concatenate((
                dcn * g * i * (1 - i), dcn * cs * f * (1 - f), do * o * (1 - o), dcn * i * (1 - g * g)
            ), 1)
            dz_all[:, t] = dz
            grads[f"H{d}"] += hs.T @ dz
            dh = (1 - m) * dh + dz @ H.T
            dc = (1 - m) * dc + dcn * f
        flat = dz_all.reshape(-1, 4 * h)
        grads[f"X{d}"] += e.reshape(len(flat), -1).T @ flat
        grads[f"c{d}"] += flat.sum(0)
        return dz_all @ self.p[f"X{d}"].T

    def gradients(self, x, mask, target):
        y, (e, s, tf, tb) = self.forward(x, mask, keep=True)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        dy = (y - target) * mask / mask.sum()
        grads["O"] = s.reshape(-1, s.shape[2]).T @ dy.reshape(-1, 1)
        grads["o"] = dy.sum(keepdims=False).reshape(1)
        ds = dy[..., None] * self.p["O"][:, 0]
        h = self.hidden
        de = self._back_direction(e, tf, ds[..., :h], "f", grads)
        de += self._back_direction(e, tb, ds[..., h:], "b", grads)
        dpre = de * (1 - e * e)
        flat = dpre.reshape(-1, dpre.shape[2])
        grads["W"] = x.reshape(len(flat), -1).T @ flat
        grads["b"] = flat.sum(0)
        return grads

    def fit(self, pages, targets, epochs=12, batch=32, rate=0.01, seed=11):
        rng = np.random.default_rng(seed)
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        order = sorted(range(len(pages)), key=lambda i: (len(pages[i]), i))
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        step = 0
        for epoch in range(epochs):
            speed = rate * (1.0 if epoch < 2 * epochs // 3 else 0.2)
            for g in rng.permutation(len(groups)):
                own = groups[g]
                x, mask = padded([pages[i] for i in own])
                y = np.zeros(mask.shape, np.float32)
                for k, i in enumerate(own):
                    y[k, : len(targets[i])] = targets[i]
                step += 1
                for k, v in self.gradients(x, mask, y).items():
                    v = np.clip(v, -1, 1)
                    m1[k] = 0.9 * m1[k] + 0.1 * v
                    m2[k] = 0.999 * m2[k] + 0.001 * v * v
                    move = m1[k] / (1 - 0.9**step) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] -= (speed * move).astype(np.float32)
        return self

    def predict(self, pages, most=1 << 14):
        """Chance of main text for every block of every page; batches of like length."""
        out = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end - at + 1) * len(pages[order[end]]) <= most:
                end += 1
            own = order[at:end]
            y, _ = self.forward(*padded([pages[i] for i in own]))
            for k, i in enumerate(own):
                out[i] = y[k, : len(pages[i])]
            at = end
        return out


def padded(pages):
    steps = max(len(p) for p in pages)
    x = np.zeros((len(pages), steps, pages[0].shape[1]), np.float32)
    mask = np.zeros((len(pages), steps), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
        mask[k, : len(p)] = 1
    return x, mask
