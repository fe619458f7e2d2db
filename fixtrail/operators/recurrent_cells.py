"""NumPy forward and backward steps of the recurrent autoencoder, run inside Spark tasks.

Arrays carry a leading axis of models, so that all training scenarios advance in the same
matrix products. Sequences are laid out as (models, time, rows, features). Gate formulas,
bias layout and initial values follow the published Keras definitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Layer widths of the autoencoder and the Adam settings.
UNITS = (32, 16, 16, 32)
LEARNING_RATE, BETA_1, BETA_2, EPSILON = 1e-3, 0.9, 0.999, 1e-7

GATES = {"gru": 3, "lstm": 4}


@dataclass(frozen=True)
class Architecture:
    window: int
    features: int
    cell: str = "gru"
    activation: str = "tanh"
    dropout: float = 0.2

    def __post_init__(self):
        if self.cell not in GATES:
            raise ValueError(f"cell must be one of {sorted(GATES)}, got {self.cell!r}")
        if self.activation not in ("tanh", "relu"):
            raise ValueError(f"unknown activation {self.activation!r}")

    def shapes(self) -> dict[str, tuple[int, ...]]:
        """Weights in storage order."""
        gates, width, out = GATES[self.cell], self.features, {}
        for layer, units in enumerate(UNITS):
            out[f"w{layer}"] = (width, gates * units)
            out[f"u{layer}"] = (units, gates * units)
            # a GRU has separate input and recurrent biases
            out[f"b{layer}"] = (2 if self.cell == "gru" else 1, gates * units)
            width = units
        out["wd"] = (width, self.features)
        out["bd"] = (1, self.features)
        return out

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.shapes().values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """Named weights as views into ``flat`` of shape (models, size)."""
        out, at = {}, 0
        for name, shape in self.shapes().items():
            n = int(np.prod(shape))
            out[name] = flat[:, at : at + n].reshape(len(flat), *shape)
            at += n
        return out

    def initial(self, seeds: list[tuple[int, ...]]) -> np.ndarray:
        """Uniform kernels, orthogonal recurrent kernels, zero biases (LSTM forget bias 1)."""
        flat = np.zeros((len(seeds), self.size))
        weights = self.views(flat)
        for model, seed in enumerate(seeds):
            rng = np.random.default_rng(seed)
            for name, shape in self.shapes().items():
                if name[0] == "w":
                    limit = np.sqrt(6 / sum(shape))
                    weights[name][model] = rng.uniform(-limit, limit, shape)
                elif name[0] == "u":
                    q, r = np.linalg.qr(rng.standard_normal(shape[::-1]))
                    weights[name][model] = (q * np.sign(np.diag(r))).T
                elif self.cell == "lstm" and name != "bd":
                    units = shape[1] // 4
                    weights[name][model, :, units : 2 * units] = 1.0
        return flat


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _activate(kind: str, x: np.ndarray) -> np.ndarray:
    return np.tanh(x) if kind == "tanh" else np.maximum(x, 0)


def _slope(kind: str, y: np.ndarray) -> np.ndarray:
    """Derivative of the activation, given its output."""
    return 1 - y * y if kind == "tanh" else (y > 0).astype(y.dtype)


def _merge(x: np.ndarray) -> np.ndarray:
    """(models, time, rows, n) -> (models, time * rows, n)."""
    return x.reshape(x.shape[0], -1, x.shape[-1])


def _t(x: np.ndarray) -> np.ndarray:
    return x.swapaxes(-1, -2)


class _Layer:
    """One recurrent layer over a whole sequence; keeps what the backward pass needs."""

    def __init__(self, arch: Architecture, layer: int, weights: dict[str, np.ndarray]):
        self.cell, self.act, self.name = arch.cell, arch.activation, layer
        self.w, self.u, self.b = (weights[f"{k}{layer}"] for k in "wub")

    def forward(self, x: np.ndarray) -> np.ndarray:
        models, (steps, rows) = len(self.w), x.shape[1:3]
        units = self.u.shape[1]
        self.x = x
        inputs = (_merge(x) @ self.w + self.b[:, :1]).reshape(models, steps, rows, -1)
        h = np.zeros((models, rows, units), inputs.dtype)
        c = np.zeros_like(h)
        self.trace, out = [], []
        for t in range(steps):
            if self.cell == "gru":
                rec = h @ self.u + self.b[:, 1:]
                gates = _sigmoid(inputs[:, t, :, : 2 * units] + rec[..., : 2 * units])
                z, r = gates[..., :units], gates[..., units:]
                inner = rec[..., 2 * units :]
                new = _activate(self.act, inputs[:, t, :, 2 * units :] + r * inner)
                self.trace.append((h, z, r, inner, new))
                h = z * h + (1 - z) * new
            else:
                total = inputs[:, t] + h @ self.u
                i = _sigmoid(total[..., :units])
                f = _sigmoid(total[..., units : 2 * units])
                g = _activate(self.act, total[..., 2 * units : 3 * units])
                o = _sigmoid(total[..., 3 * units :])
                before, c = c, f * c + i * g
                shown = _activate(self.act, c)
                self.trace.append((h, before, i, f, g, o, shown))
                h = o * shown
            out.append(h)
        return np.stack(out, axis=1)

    def backward(self, grad: np.ndarray, into: dict[str, np.ndarray]) -> np.ndarray:
        """Gradient w.r.t. the input; weight gradients go to ``into``."""
        steps, rows, units = grad.shape[1:]
        later_h = np.zeros_like(grad[:, 0])
        later_c = np.zeros_like(later_h)
        d_in, d_rec, states = [], [], []
        for t in reversed(range(steps)):
            dh = grad[:, t] + later_h
            if self.cell == "gru":
                h, z, r, inner, new = self.trace[t]
                da = dh * (1 - z) * _slope(self.act, new)
                dz = dh * (h - new) * z * (1 - z)
                dr = da * inner * r * (1 - r)
                d_in.append(np.concatenate([dz, dr, da], axis=-1))
                d_rec.append(np.concatenate([dz, dr, da * r], axis=-1))
                later_h = dh * z + d_rec[-1] @ _t(self.u)
            else:
                h, before, i, f, g, o, shown = self.trace[t]
                dc = later_c + dh * o * _slope(self.act, shown)
                parts = [
                    dc * g * i * (1 - i),
                    dc * before * f * (1 - f),
                    dc * i * _slope(self.act, g),
                    dh * shown * o * (1 - o),
                ]
                d_in.append(np.concatenate(parts, axis=-1))
                d_rec.append(d_in[-1])
                later_c = dc * f
                later_h = d_in[-1] @ _t(self.u)
            states.append(h)
        d_in, d_rec, states = (np.stack(v[::-1], axis=1) for v in (d_in, d_rec, states))
        flat_in, flat_rec = _merge(d_in), _merge(d_rec)
        n = self.name
        into[f"w{n}"][...] = _t(_merge(self.x)) @ flat_in
        into[f"u{n}"][...] = _t(_merge(states)) @ flat_rec
        into[f"b{n}"][:, 0] = flat_in.sum(axis=1)
        if self.cell == "gru":
            into[f"b{n}"][:, 1] = flat_rec.sum(axis=1)
        return (flat_in @ _t(self.w)).reshape(*grad.shape[:3], -1)


class Autoencoder:
    """Encoder of widths 32 and 16, mirrored decoder, linear output per time step."""

    def __init__(self, arch: Architecture, flat: np.ndarray):
        self.arch, self.flat = arch, flat
        weights = arch.views(flat)
        self.layers = [_Layer(arch, i, weights) for i in range(4)]
        self.wd, self.bd = weights["wd"], weights["bd"]

    def forward(self, x: np.ndarray, rng: np.random.Generator | None = None) -> np.ndarray:
        """Reconstruction of ``x``; dropout is active only with ``rng``."""
        first, second, third, fourth = self.layers
        self.masks = []

        def drop(y: np.ndarray) -> np.ndarray:
            if rng is None or not self.arch.dropout:
                self.masks.append(None)
                return y
            keep = 1 - self.arch.dropout
            self.masks.append((rng.random(y.shape) < keep).astype(y.dtype) / keep)
            return y * self.masks[-1]

        code = second.forward(drop(first.forward(x)))[:, -1:]
        wide = np.broadcast_to(code, (code.shape[0], x.shape[1], *code.shape[2:]))
        self.top = fourth.forward(drop(third.forward(wide)))
        out = _merge(self.top) @ self.wd + self.bd
        return out.reshape(*self.top.shape[:3], -1)

    def backward(self, grad: np.ndarray) -> np.ndarray:
        """Gradient of all weights in the layout of ``flat``."""
        out = np.zeros_like(self.flat)
        into = self.arch.views(out)
        first, second, third, fourth = self.layers
        flat = _merge(grad)
        into["wd"][...] = _t(_merge(self.top)) @ flat
        into["bd"][:, 0] = flat.sum(axis=1)
        down = fourth.backward((flat @ _t(self.wd)).reshape(self.top.shape), into)
        down = third.backward(down if self.masks[1] is None else down * self.masks[1], into)
        code = np.zeros((*down.shape[:3], UNITS[1]), down.dtype)
        code[:, -1] = down.sum(axis=1)
        down = second.backward(code, into)
        first.backward(down if self.masks[0] is None else down * self.masks[0], into)
        return out

    def errors(self, x: np.ndarray) -> np.ndarray:
        """Mean squared reconstruction error per model and row; ``x`` is (rows, time, f)."""
        steps = np.ascontiguousarray(x.astype(self.flat.dtype).swapaxes(0, 1))[None]
        guess = self.forward(steps).astype(np.float64)
        return np.mean((x.swapaxes(0, 1)[None] - guess) ** 2, axis=(1, 3))


@dataclass
class TrainingState:
    """Weights and Adam moments of several models, (models, size) each."""

    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: np.ndarray

    def copy(self) -> TrainingState:
        return TrainingState(*(a.copy() for a in vars(self).values()))


def _batches(counts: list[int], batch: int, rng: np.random.Generator) -> Iterator[list[np.ndarray]]:
    """Shuffled row positions, one array per model; models that have run out get none."""
    orders = [rng.permutation(n) for n in counts]
    for at in range(0, max(counts), batch):
        yield [order[at : at + batch] for order in orders]


def train_epoch(
    arch: Architecture,
    state: TrainingState,
    rows: np.ndarray,
    members: np.ndarray,
    batch: int,
    rng: np.random.Generator,
) -> np.ndarray:
    """One pass of mini-batches over ``rows`` (rows, time, features), updating ``state``.

    ``members`` (models, rows) tells which rows each model learns from. Returns the summed
    loss per model, weighted by rows.
    """
    own = [np.flatnonzero(m) for m in members]
    losses = np.zeros(len(own))
    dtype = state.weights.dtype
    for picks in _batches([len(o) for o in own], batch, rng):
        width = max(len(p) for p in picks)
        counts = np.array([len(p) for p in picks])
        live = counts > 0
        x = np.zeros((len(own), width, *rows.shape[1:]), dtype)
        for model, pick in enumerate(picks):
            x[model, : len(pick)] = rows[own[model][pick]]
        x = np.ascontiguousarray(x.swapaxes(1, 2))
        net = Autoencoder(arch, state.weights)
        used = (np.arange(width) < counts[:, None]).astype(dtype)[:, None, :, None]
        gap = (net.forward(x, rng) - x) * used
        per_row = arch.window * arch.features
        losses += np.sum(gap.astype(np.float64) ** 2, axis=(1, 2, 3)) / per_row
        scale = (2 / (np.maximum(counts, 1) * per_row)).astype(dtype)
        grad = net.backward(gap * scale[:, None, None, None])
        _adam(state, grad, live)
    return losses


def _adam(state: TrainingState, grad: np.ndarray, live: np.ndarray) -> None:
    state.steps[live] += 1
    if not live.all():
        grad = grad[live]
    first = BETA_1 * state.first[live] + (1 - BETA_1) * grad
    second = BETA_2 * state.second[live] + (1 - BETA_2) * grad * grad
    t = state.steps[live]
    rate = LEARNING_RATE * np.sqrt(1 - BETA_2**t) / (1 - BETA_1**t)
    step = rate[:, None].astype(grad.dtype) * first / (np.sqrt(second) + EPSILON)
    state.first[live], state.second[live] = first, second
    state.weights[live] -= step.astype(grad.dtype)
