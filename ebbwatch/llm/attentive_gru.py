"""A bidirectional gated recurrent layer with attention pooling, forwards and backwards, in numpy.

Sequences of a batch are sorted by length, longest first, so that every step works on those still going.
"""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_layer(rng: np.random.Generator, inputs: int, hidden: int, name: str) -> Params:
    out = {}
    for side in "fb":
        out[f"{name}.W{side}"] = rng.standard_normal((inputs, 3 * hidden)) / np.sqrt(inputs)
        out[f"{name}.U{side}"] = rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)
        out[f"{name}.b{side}"] = np.zeros(3 * hidden)
    out[f"{name}.v"] = rng.standard_normal(2 * hidden) * 0.1
    return {k: v.astype(np.float32) for k, v in out.items()}


def going(lengths: np.ndarray, steps: int) -> np.ndarray:
    """How many of the sequences, longest first, have a step t."""
    return np.searchsorted(-lengths, -np.arange(steps), "left")


def scan(gates, weights: np.ndarray, counts: np.ndarray, back: bool, size: int, kept: list | None = None) -> np.ndarray:
    """States of one direction, (steps, size, hidden), zero where a sequence has ended.

    ``gates(t, n)`` has the input's part of the gates at step t for the first n sequences.
    """
    hidden = weights.shape[0]
    states = np.zeros((len(counts), size, hidden), np.float32)
    h = np.zeros((size, hidden), np.float32)
    for t in range(len(counts) - 1, -1, -1) if back else range(len(counts)):
        n = counts[t]
        if not n:
            continue
        g, u, old = gates(t, n), h[:n] @ weights, h[:n]
        zr = sigmoid(g[:, : 2 * hidden] + u[:, : 2 * hidden])
        z, r, q = zr[:, :hidden], zr[:, hidden:], u[:, 2 * hidden :]
        new = np.tanh(g[:, 2 * hidden :] + r * q)
        if kept is not None:
            kept.append((t, n, old.copy(), z, r, q, new))
        h[:n] = new + z * (old - new)
        states[t, :n] = h[:n]
    return states


def pooled(states: np.ndarray, v: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Attention-weighted sum of the states, (size, 2 hidden), and the weights."""
    scores = states @ v
    for t, n in enumerate(counts):
        scores[t, n:] = -np.inf
    most = scores.max(axis=0, initial=-1e30)
    weights = np.exp(scores - most)
    weights /= np.maximum(weights.sum(axis=0), 1e-30)
    return np.einsum("ts,tsh->sh", weights, states), weights


class Layer:
    """One pass over a batch, with what its gradient needs."""

    def __init__(self, params: Params, name: str, inputs: np.ndarray, lengths: np.ndarray):
        """``inputs`` is (steps, size, features)."""
        self.params, self.name, self.inputs = params, name, inputs
        self.counts = going(lengths, len(inputs))
        self.kept: dict[str, list] = {"f": [], "b": []}
        sides = []
        for side in "fb":
            gates = inputs @ params[f"{name}.W{side}"] + params[f"{name}.b{side}"]
            sides.append(
                scan(lambda t, n, g=gates: g[t, :n], params[f"{name}.U{side}"], self.counts, side == "b", inputs.shape[1], self.kept[side])
            )
        self.states = np.concatenate(sides, axis=2)
        self.out, self.weights = pooled(self.states, params[f"{name}.v"], self.counts)

    def backward(self, d_out: np.ndarray, grads: Params) -> np.ndarray:
        """Adds the parameters' gradients; gives that of the inputs."""
        name, a, states = self.name, self.weights, self.states
        along = np.einsum("tsh,sh->ts", states, d_out)
        g = a * (along - (a * along).sum(axis=0))
        grads[f"{name}.v"] += np.einsum("ts,tsh->h", g, states)
        d_states = a[:, :, None] * d_out + g[:, :, None] * self.params[f"{name}.v"]
        hidden = states.shape[2] // 2
        d_inputs = np.zeros_like(self.inputs)
        for k, side in enumerate("fb"):
            weights, dh = self.params[f"{name}.U{side}"], np.zeros((states.shape[1], hidden), np.float32)
            d_gates = np.zeros((*self.inputs.shape[:2], 3 * hidden), np.float32)
            for t, n, old, z, r, q, new in reversed(self.kept[side]):
                d = dh[:n] + d_states[t, :n, k * hidden : (k + 1) * hidden]
                d_new = d * (1 - z) * (1 - new * new)
                d_z, d_r = d * (old - new) * z * (1 - z), d_new * q * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_gates[t, :n] = np.concatenate([d_z, d_r, d_new], axis=1)
                grads[f"{name}.U{side}"] += old.T @ d_u
                dh[:n] = d * z + d_u @ weights.T
            flat = d_gates.reshape(-1, 3 * hidden)
            grads[f"{name}.W{side}"] += self.inputs.reshape(len(flat), -1).T @ flat
            grads[f"{name}.b{side}"] += flat.sum(axis=0)
            d_inputs += d_gates @ self.params[f"{name}.W{side}"].T
        return d_inputs


class Adam:
    def __init__(self, params: Params, rate: float = 0.01):
        self.params, self.rate, self.n = params, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in params.items()}
        self.second = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: Params) -> None:
        self.n += 1
        for k, g in grads.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            first, second = self.first[k] / (1 - 0.9**self.n), self.second[k] / (1 - 0.999**self.n)
            self.params[k] -= (self.rate * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
