"""A character tagger in numpy: a bidirectional LSTM under a linear-chain CRF.

Texts are windows of ``WINDOW`` characters, given as class numbers; tags are 0
for outside and, for kind k, 1 + 2 k where a span begins and 2 + 2 k inside it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

WINDOW = 96
HIDDEN = 24
#: Windows run through the network at a time.
BATCH = 512
#: Greatest norm of a step's gradient.
CLIP = 25.0

_PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
#: Class of a code point below 128; 0 is padding, all digits are one class, letters lose their case.
CLASSES = np.zeros(128, np.uint8)
CLASSES[:] = 63
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    CLASSES[[ord(_c), ord(_c.upper())]] = 2 + _i
CLASSES[[ord(_c) for _c in "0123456789"]] = 1
CLASSES[[ord(_c) for _c in "\n\x0b\x0c\r"]] = 29
CLASSES[[ord(_c) for _c in " \t"]] = 30
for _i, _c in enumerate(_PUNCTUATION):
    CLASSES[ord(_c)] = 31 + _i
_WIDE = 28
N_CLASSES = 64


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, CLASSES[np.minimum(points, 127)], _WIDE).astype(np.uint8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Tagger:
    tags: int
    hidden: int = HIDDEN
    seed: int = 0
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.p:
            return
        rng, h = np.random.default_rng(self.seed), self.hidden
        make = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        # Both directions side by side; gates in order input, forget, output, candidate.
        bias = np.zeros((2, 1, 4 * h), np.float32)
        bias[:, :, h : 2 * h] = 1
        self.p = {"x": make(2, N_CLASSES, 4 * h, s=0.3), "h": make(2, h, 4 * h, s=h**-0.5), "b": bias, "out": make(2 * h, self.tags, s=(2 * h) ** -0.5), "ob": np.zeros(self.tags, np.float32), "to": np.zeros((self.tags, self.tags), np.float32)}

    def _states(self, ids: np.ndarray, keep: bool):
        """States (2, T, B, H) of windows (B, T); with ``keep`` also what the gradients need."""
        h, (n, steps) = self.hidden, ids.shape
        both = np.stack([ids.T, ids.T[::-1]])  # (2, T, B)
        state, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        out = np.empty((2, steps, n, h), np.float32)
        kept = []
        for t in range(steps):
            z = np.stack([self.p["x"][0][both[0, t]], self.p["x"][1][both[1, t]]]) + state @ self.p["h"] + self.p["b"]
            gates, new = _sigmoid(z[:, :, : 3 * h]), np.tanh(z[:, :, 3 * h :])
            i, f, o = gates[:, :, :h], gates[:, :, h : 2 * h], gates[:, :, 2 * h :]
            before, cell = cell, f * cell + i * new
            bent = np.tanh(cell)
            if keep:
                kept.append((state, before, i, f, o, new, bent))
            state = o * bent
            out[:, t] = state
        return both, out, kept

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """(T, B, tags)."""
        _, out, _ = self._states(ids, False)
        return np.concatenate([out[0], out[1][::-1]], axis=2) @ self.p["out"] + self.p["ob"]

    def _passes(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log-sums (T, B, tags) and the log-partition (B)."""
        to = self.p["to"]
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0]
        for t in range(1, len(e)):
            s = a[t - 1][:, :, None] + to
            top = s.max(axis=1)
            a[t] = top + np.log(np.exp(s - top[:, None]).sum(axis=1)) + e[t]
        for t in range(len(e) - 2, -1, -1):
            s = to + (e[t + 1] + b[t + 1])[:, None, :]
            top = s.max(axis=2)
            b[t] = top + np.log(np.exp(s - top[:, :, None]).sum(axis=2))
        top = a[-1].max(axis=1)
        return a, b, top + np.log(np.exp(a[-1] - top[:, None]).sum(axis=1))

    def gradients(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the gold tags (B, T), and its gradients."""
        h, (n, steps) = self.hidden, ids.shape
        both, out, kept = self._states(ids, True)
        joined = np.concatenate([out[0], out[1][::-1]], axis=2)
        e = joined @ self.p["out"] + self.p["ob"]
        a, b, z = self._passes(e)
        g, rows = gold.T, np.arange(n)
        right = sum(e[t, rows, g[t]] for t in range(steps)) + sum(self.p["to"][g[t], g[t + 1]] for t in range(steps - 1))
        de = np.exp(a + b - z[None, :, None])
        d_to = np.zeros_like(self.p["to"])
        for t in range(steps - 1):
            pair = a[t][:, :, None] + self.p["to"] + (e[t + 1] + b[t + 1])[:, None, :] - z[:, None, None]
            d_to += np.exp(pair).sum(axis=0)
            np.add.at(d_to, (g[t], g[t + 1]), -1)
        for t in range(steps):
            de[t, rows, g[t]] -= 1
        de /= n
        grads = {"to": d_to / n, "out": np.tensordot(joined, de, ((0, 1), (0, 1))), "ob": de.sum(axis=(0, 1))}
        back = de @ self.p["out"].T
        d_out = np.stack([back[:, :, :h], back[::-1, :, h:]])  # in each direction's own order
        d_state, d_cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        dz_all = np.empty((2, steps, n, 4 * h), np.float32)
        d_h = np.zeros_like(self.p["h"])
        for t in range(steps - 1, -1, -1):
            state, before, i, f, o, new, bent = kept[t]
            d_state = d_state + d_out[:, t]
            d_cell = d_cell + d_state * o * (1 - bent * bent)
            dz = dz_all[:, t]
            dz[:, :, :h] = d_cell * new * i * (1 - i)
            dz[:, :, h : 2 * h] = d_cell * before * f * (1 - f)
            dz[:, :, 2 * h : 3 * h] = d_state * bent * o * (1 - o)
            dz[:, :, 3 * h :] = d_cell * i * (1 - new * new)
            d_h += state.transpose(0, 2, 1) @ dz
            d_state, d_cell = dz @ self.p["h"].transpose(0, 2, 1), d_cell * f
        flat = dz_all.reshape(2, steps * n, 4 * h)
        hot = np.eye(N_CLASSES, dtype=np.float32)
        grads |= {"h": d_h, "b": flat.sum(axis=1, keepdims=True), "x": np.stack([hot[both[k].ravel()].T @ flat[k] for k in (0, 1)])}
        return float((z - right).mean()), grads

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest tags (B, T) of windows (B, T), and the posterior probability that a character is outside."""
        tags, outside = np.empty(ids.shape, np.int8), np.empty(ids.shape, np.float32)
        for at in range(0, len(ids), BATCH):
            part = ids[at : at + BATCH]
            e = self.emissions(part)
            best, back = e[0], np.zeros(e.shape, np.int8)
            for t in range(1, len(e)):
                s = best[:, :, None] + self.p["to"]
                back[t] = s.argmax(axis=1)
                best = s.max(axis=1) + e[t]
            now = best.argmax(axis=1)
            rows = np.arange(len(part))
            for t in range(len(e) - 1, -1, -1):
                tags[at : at + BATCH, t] = now
                now = back[t, rows, now]
            a, b, z = self._passes(e)
            outside[at : at + BATCH] = np.exp(a[:, :, 0] + b[:, :, 0] - z).T
        return tags, outside


def train(examples, tags: int, epochs: int, batch: int = 64, rate: float = 8e-3, seed: int = 0, hidden: int = HIDDEN) -> Tagger:
    """Adam on what ``examples(epoch)`` gives, (windows, gold tags); every step is a function of the seed."""
    model, rng = Tagger(tags, hidden, seed), np.random.default_rng(seed)
    m, v, step = {k: np.zeros_like(x) for k, x in model.p.items()}, {k: np.zeros_like(x) for k, x in model.p.items()}, 0
    for epoch in range(epochs):
        ids, gold = examples(epoch)
        order = rng.permutation(len(ids))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            _, grads = model.gradients(ids[pick], gold[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            pace, clip = rate * (1 - 0.9 * epoch / epochs), min(1.0, CLIP / (norm + 1e-12))
            for k, g in grads.items():
                g = g * clip
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                model.p[k] = (model.p[k] - pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model
