"""A small causal self-attention model over tokens, trained and run in numpy.

The model has one attention head over windows of ``WINDOW`` tokens and predicts the next token's class.
Windows overlap by half: the second half's next tokens are scored, each once, with the first half as
context. Positions before a document's start (and after its end, which no scored position sees) hold a
token of their own, ``none``.
"""

from __future__ import annotations

import numpy as np

WINDOW, HALF, WIDTH = 32, 16, 16
_CAUSAL = (np.arange(WINDOW)[None, :] <= np.arange(HALF, WINDOW)[:, None]).astype(np.float32)
LIMIT = np.float32(40)  # of exponents, so that sums stay finite without a pass for the largest


def initial(classes: int, seed: int = 11) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return (r.standard_normal(shape) * 0.1).astype(np.float32)

    return {
        "e": draw(classes + 1, WIDTH), "p": draw(WINDOW, WIDTH), "q": draw(WIDTH, WIDTH), "k": draw(WIDTH, WIDTH),
        "v": draw(WIDTH, WIDTH), "o": draw(WIDTH, classes), "b": np.zeros(classes, np.float32),
    }


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[n].ravel() for n in sorted(w)])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for n in sorted(like):
        out[n] = values[at : at + like[n].size].reshape(like[n].shape).astype(np.float32, copy=False)
        at += like[n].size
    return out


def windows(ids: np.ndarray, lengths: np.ndarray, start: int, none: int, goals: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of inputs, their scored targets (-1: no target) and their document's place, for documents in a row.

    ``start`` is the id that stands before a document's first; every length is at least 1. ``goals`` are the
    classes to predict, one for each id (without: the ids themselves)."""
    rows = -(-lengths // HALF)
    at = np.cumsum((rows + 2) * HALF) - (rows + 2) * HALF  # a document's place among all padded ones
    size = int((rows + 2).sum()) * HALF
    inputs, targets = np.full(size, none, np.int32), np.full(size + 1, -1, np.int16)
    place = np.arange(len(ids)) + np.repeat(at + HALF + 1 - (np.cumsum(lengths) - lengths), lengths)
    inputs[at + HALF] = start
    inputs[place] = ids
    targets[place] = ids if goals is None else goals
    owner = np.repeat(np.arange(len(rows)), rows)
    n = np.arange(len(owner)) + 2 * owner  # windows begin at every half; the last two of a document run over its end
    view = np.lib.stride_tricks.sliding_window_view
    return view(inputs, WINDOW)[::HALF][n], view(targets[HALF + 1 :], HALF)[::HALF][n], owner


def _exp(a: np.ndarray) -> np.ndarray:
    np.minimum(a, LIMIT, out=a)
    return np.exp(a, out=a)


def _times(a: np.ndarray, m: np.ndarray) -> np.ndarray:
    """One matrix product for the whole batch."""
    return (a.reshape(-1, a.shape[-1]) @ m).reshape(*a.shape[:-1], m.shape[1])


def _places(rows: np.ndarray, size: int) -> np.ndarray:
    """Places of the numbers of each row in an array of ``size`` rows as one vector."""
    return np.take(np.arange(size * WIDTH).reshape(size, WIDTH), rows, axis=0).ravel()


def _attend(w: dict[str, np.ndarray], inputs: np.ndarray) -> tuple[np.ndarray, ...]:
    x = np.take(w["e"], inputs, axis=0)
    x += w["p"]
    late = x[:, HALF:]
    q, k, v = _times(late, w["q"] * np.float32(WIDTH**-0.5)), _times(x, w["k"]), _times(x, w["v"])
    p = _exp(q @ np.ascontiguousarray(k.transpose(0, 2, 1)))
    p *= _CAUSAL
    total = (p @ np.ones(WINDOW, np.float32))[..., None]  # a product is faster than a short sum
    return x, late, q, k, v, p, total, late + (p @ v) / total


def tables(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Key, value, query and input of every token and of every place: a window's are sums of two.

    Values have one more column of ones: it sums the attention, and meets the bias as one more row of ``o``."""
    q, column = w["q"] * np.float32(WIDTH**-0.5), lambda m, last: np.pad(m, ((0, 0), (0, 1)), constant_values=last)
    out = {"ke": w["e"] @ w["k"], "ve": column(w["e"] @ w["v"], 1), "qe": w["e"] @ q, "xe": column(w["e"], 0)}
    out |= {"kp": w["p"] @ w["k"], "vp": column(w["p"] @ w["v"], 0), "qp": w["p"][HALF:] @ q, "xp": column(w["p"][HALF:], 0)}
    return out | {"o": np.vstack([w["o"], w["b"]])}


def log_probs(t: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target class (0 where there is none); ``t``: see ``tables``."""
    late = inputs[:, HALF:]
    k, v, q, h = (np.take(t[n + "e"], at, axis=0) for n, at in (("k", inputs), ("v", inputs), ("q", late), ("x", late)))
    k += t["kp"]
    v += t["vp"]
    q += t["qp"]
    h += t["xp"]
    p = _exp(q @ np.ascontiguousarray(k.transpose(0, 2, 1)))
    p *= _CAUSAL
    mixed = p @ v
    mixed /= mixed[..., -1:]
    h += mixed
    z = h.reshape(-1, h.shape[-1]) @ t["o"]
    np.minimum(z, LIMIT, out=z)
    goal, classes = targets.ravel(), z.shape[1]
    own = np.take(z, np.maximum(goal, 0) + np.arange(0, z.size, classes))
    total = np.exp(z, out=z) @ np.ones(classes, z.dtype)
    return np.where(goal >= 0, own - np.log(total), 0.0).reshape(targets.shape)


def gradients(w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    x, late, q, k, v, p, total, h = _attend(w, inputs)
    p /= total
    flat2 = lambda m: m.reshape(-1, m.shape[-1])
    turned = lambda m: np.ascontiguousarray(m.transpose(0, 2, 1))
    h = flat2(h)
    dz = h @ w["o"]
    dz += w["b"]
    dz = _exp(dz)
    goal = targets.ravel()
    there = np.flatnonzero(goal >= 0)
    share = np.float32(1 / max(1, len(there)))
    scale = np.where(goal >= 0, share, np.float32(0)) / (dz @ np.ones(dz.shape[1], dz.dtype))
    dz *= scale[:, None]
    dz.ravel()[there * dz.shape[1] + goal[there]] -= share
    dh = (dz @ w["o"].T).reshape(late.shape)
    da = dh @ turned(v)
    da -= (da * p).sum(-1, keepdims=True)
    da *= p
    dq, dk, dv = (da @ k) * np.float32(WIDTH**-0.5), turned(da) @ q, turned(p) @ dh
    dx = _times(dk, w["k"].T)
    dx += _times(dv, w["v"].T)
    dx[:, HALF:] += dh
    dx[:, HALF:] += _times(dq, w["q"].T)
    place = _places(inputs.ravel(), len(w["e"]))
    de = np.bincount(place, dx.ravel(), w["e"].size).reshape(w["e"].shape).astype(np.float32)
    return {
        "e": de, "p": dx.sum(0), "q": flat2(late).T @ flat2(dq), "k": flat2(x).T @ flat2(dk), "v": flat2(x).T @ flat2(dv),
        "o": h.T @ dz, "b": dz.sum(0),
    }


class Adam:
    """Adam over the class model's weights as one vector, and over the token rows that a batch uses.

    A token's input is its class's row of ``e`` plus a row of its own (``rows``), so a token seen seldom
    falls back on its class. Rows that a batch doesn't use stay as they are.
    """

    def __init__(self, values: np.ndarray, rows: np.ndarray, class_of: np.ndarray, like: dict[str, np.ndarray], rate: float):
        self.values, self.like, self.rate, self.n = values.astype(np.float32), like, rate, 0
        self.rows, self.class_of = rows.astype(np.float32), class_of
        self.uses = np.zeros(len(rows), np.int64)
        self._place = np.zeros(len(rows), np.int64)  # of a batch's tokens among those it uses
        self._m, self._s = np.zeros_like(self.values), np.zeros_like(self.values)
        self._row_m, self._row_s = np.zeros_like(self.rows), np.zeros_like(self.rows)

    def _move(self, d: np.ndarray, m: np.ndarray, s: np.ndarray) -> np.ndarray:
        m += np.float32(0.1) * (d - m)
        s += np.float32(0.01) * (d * d - s)
        scale = self.rate / (1 - 0.9**self.n) * np.sqrt(1 - 0.99**self.n)
        return np.float32(scale) * m / (np.sqrt(s) + np.float32(1e-8))

    def step(self, inputs: np.ndarray, targets: np.ndarray) -> None:
        ordered = np.sort(inputs, axis=None)
        used = ordered[np.append(True, ordered[1:] != ordered[:-1])]
        self._place[used] = np.arange(len(used))
        at = np.take(self._place, inputs)
        kinds, rows = np.take(self.class_of, used), np.take(self.rows, used, axis=0)
        w = shaped(self.values, self.like)
        g = gradients(w | {"e": np.take(w["e"], kinds, axis=0) + rows}, at, targets)
        own = g["e"]
        shared = np.zeros_like(w["e"])
        np.add.at(shared.ravel(), _places(kinds, len(shared)), own.ravel())  # on vectors it is several times faster
        self.n += 1
        self.uses[used] += np.bincount(at.ravel())
        self.values -= self._move(flat(g | {"e": shared}), self._m, self._s)
        m, s = np.take(self._row_m, used, axis=0), np.take(self._row_s, used, axis=0)
        rows -= self._move(own, m, s)
        self.rows[used], self._row_m[used], self._row_s[used] = rows, m, s
