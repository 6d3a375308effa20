"""Gated recurrent layers in numpy, forward and by backpropagation through time.

Arrays are (features, lanes): lanes are independent sequences that move in step.
Gates use x / (1 + |x|) instead of exponentials, in training and in use."""

from __future__ import annotations

import numpy as np


def squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def squash_slope(y: np.ndarray) -> np.ndarray:
    """Slope of ``squash`` where its value is ``y``."""
    return np.square(1 - np.abs(y))


def step(inputs: np.ndarray, recurrent: np.ndarray, h: np.ndarray, mask: np.ndarray | None):
    """One step; ``inputs`` are the (3 H, lanes) projections of what is read. Lanes
    whose mask is 0 keep their state. Returns the state and what the way back needs."""
    size = len(h)
    m = recurrent @ h
    gates = inputs[: 2 * size] + m[: 2 * size]
    gates = 0.5 + 0.5 * squash(gates)
    z, r = gates[:size], gates[size:]
    if mask is not None:
        z *= mask
    n = squash(inputs[2 * size :] + r * m[2 * size :])
    return h + z * (n - h), (h, z, r, n, m[2 * size :])


def run(inputs, recurrent: np.ndarray, masks, backwards: bool = False):
    """Yield step, state and cache over all steps; ``inputs(t)`` gives a step's
    projections and ``masks[t]`` its mask."""
    steps = range(len(masks))
    h = np.zeros((recurrent.shape[1], masks.shape[1]), np.float32)
    for t in reversed(steps) if backwards else steps:
        h, cache = step(inputs(t), recurrent, h, masks[t])
        yield t, h, cache


def back(caches: list, slopes: list, recurrent: np.ndarray, masks: np.ndarray):
    """Backpropagation through time. ``caches`` and ``slopes`` (the loss by each
    state) are in the order the steps were taken, with their t. Yields t and the
    slope by its inputs; the last value is the slope by the recurrent weights."""
    size = recurrent.shape[1]
    total = np.zeros_like(recurrent)
    carried = np.zeros_like(slopes[0][1])
    out = []
    for (t, (before, z, r, n, m)), (_, slope) in zip(reversed(caches), reversed(slopes), strict=True):
        dh = carried + slope
        dn = dh * z * squash_slope(n)
        dz = dh * (n - before) * masks[t]
        dz *= 0.5 * squash_slope(2 * z - 1)
        dr = dn * m * (0.5 * squash_slope(2 * r - 1))
        dm = np.concatenate([dz, dr, dn * r])
        total += dm @ before.T
        carried = dh * (1 - z) + recurrent.T @ dm
        out.append((t, np.concatenate([dz, dr, dn])))
    return out, total


class Adam:
    """Adam steps over a dict of arrays, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float) -> None:
        self.weights, self.rate, self.t = weights, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, slopes: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in slopes.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (np.square(g) - self.second[k])
            mean, power = self.first[k] / (1 - 0.9**self.t), self.second[k] / (1 - 0.999**self.t)
            self.weights[k] -= (self.rate * mean / (np.sqrt(power) + 1e-8)).astype(self.weights[k].dtype)


def drawn(random: np.random.Generator, *shape: int, scale: float) -> np.ndarray:
    return (random.standard_normal(shape) * scale).astype(np.float32)
