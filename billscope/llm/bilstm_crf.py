"""A small character-level bidirectional LSTM with a CRF on top, in numpy: training and decoding.

Inputs are windows of equal length as character classes, shape (time, window). Weights are one flat dictionary
of arrays. The classes and tags are the caller's.
"""

from __future__ import annotations

import numpy as np

EMBEDDING, HIDDEN = 8, 16


def new_weights(classes: int, tags: int, seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    weights = {"embedding": draw(classes, EMBEDDING), "out": draw(2 * HIDDEN, tags), "out_bias": np.zeros(tags)}
    for way in ("forward", "backward"):
        weights[f"{way}_in"], weights[f"{way}_on"] = draw(EMBEDDING, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)
        weights[f"{way}_bias"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return weights | {"move": np.zeros((tags, tags)), "begin": np.zeros(tags)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lstm(inputs: np.ndarray, on: np.ndarray, kept: list | None) -> np.ndarray:
    """States for gate inputs (time, window, 4 x hidden); ``kept`` collects what the way back needs."""
    state = cell = np.zeros((inputs.shape[1], HIDDEN))
    out = np.empty((*inputs.shape[:2], HIDDEN))
    for t, own in enumerate(inputs):
        gates = own + state @ on
        let_in, keep, show = np.split(_sigmoid(gates[:, : 3 * HIDDEN]), 3, 1)
        new = np.tanh(gates[:, 3 * HIDDEN :])
        before, cell = cell, keep * cell + let_in * new
        squashed = np.tanh(cell)
        if kept is not None:
            kept.append((state, before, let_in, keep, show, new, squashed))
        state = show * squashed
        out[t] = state
    return out


def _lstm_back(grad: np.ndarray, on: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gate inputs and of ``on``."""
    gates, on_grad = np.empty((*grad.shape[:2], 4 * HIDDEN)), np.zeros_like(on)
    state_grad = cell_grad = np.zeros(grad.shape[1:])
    for t in range(len(kept) - 1, -1, -1):
        state, before, let_in, keep, show, new, squashed = kept[t]
        state_grad = grad[t] + state_grad
        cell_grad = cell_grad + state_grad * show * (1 - squashed**2)
        gates[t] = np.concatenate(
            [
                cell_grad * new * let_in * (1 - let_in),
                cell_grad * before * keep * (1 - keep),
                state_grad * squashed * show * (1 - show),
                cell_grad * let_in * (1 - new**2),
            ],
            1,
        )
        on_grad += state.T @ gates[t]
        state_grad, cell_grad = gates[t] @ on.T, cell_grad * keep
    return gates, on_grad


def scores(weights: dict[str, np.ndarray], chars: np.ndarray, kept: dict | None = None) -> np.ndarray:
    """Tag scores (time, window, tag)."""
    letters, states = weights["embedding"][chars], []
    for way, step in (("forward", 1), ("backward", -1)):
        own = [] if kept is not None else None
        inputs = letters[::step] @ weights[f"{way}_in"] + weights[f"{way}_bias"]
        states.append(_lstm(inputs, weights[f"{way}_on"], own)[::step])
        if kept is not None:
            kept[way] = own
    both = np.concatenate(states, 2)
    if kept is not None:
        kept |= {"letters": letters, "both": both}
    return both @ weights["out"] + weights["out_bias"]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _sums(weights: dict[str, np.ndarray], emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log sums over all tag paths: up to each tag, after each tag, in all."""
    move, ahead, behind = weights["move"], np.empty_like(emitted), np.zeros_like(emitted)
    ahead[0] = weights["begin"] + emitted[0]
    for t in range(1, len(emitted)):
        ahead[t] = _log_sum(ahead[t - 1][:, :, None] + move, 1) + emitted[t]
    for t in range(len(emitted) - 2, -1, -1):
        behind[t] = _log_sum(move + (emitted[t + 1] + behind[t + 1])[:, None, :], 2)
    return ahead, behind, _log_sum(ahead[-1], 1)


def gradients(weights: dict[str, np.ndarray], chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood a window, and its gradient."""
    kept: dict = {}
    emitted = scores(weights, chars, kept)
    ahead, behind, total = _sums(weights, emitted)
    count = chars.shape[1]
    gold = np.eye(emitted.shape[2])[tags]
    path = weights["begin"][tags[0]] + (emitted * gold).sum((0, 2))
    path = path + weights["move"][tags[:-1], tags[1:]].sum(0)
    share = np.exp(ahead + behind - total[:, None])
    grads = {"begin": (share[0] - gold[0]).sum(0) / count}
    pairs = np.exp(ahead[:-1, :, :, None] + weights["move"] + (emitted + behind)[1:, :, None, :] - total[:, None, None])
    grads["move"] = pairs.sum((0, 1))
    np.add.at(grads["move"], (tags[:-1], tags[1:]), -1.0)
    grads["move"] /= count
    emitted_grad = (share - gold) / count
    both_grad = emitted_grad @ weights["out"].T
    grads["out"] = np.tensordot(kept["both"], emitted_grad, ((0, 1), (0, 1)))
    grads["out_bias"] = emitted_grad.sum((0, 1))
    letters_grad = np.zeros_like(kept["letters"])
    for way, step, part in (("forward", 1, slice(0, HIDDEN)), ("backward", -1, slice(HIDDEN, None))):
        gates, grads[f"{way}_on"] = _lstm_back(both_grad[::step, :, part], weights[f"{way}_on"], kept[way])
        grads[f"{way}_in"] = np.tensordot(kept["letters"][::step], gates, ((0, 1), (0, 1)))
        grads[f"{way}_bias"] = gates.sum((0, 1))
        letters_grad += (gates @ weights[f"{way}_in"].T)[::step]
    grads["embedding"] = np.zeros_like(weights["embedding"])
    np.add.at(grads["embedding"], chars, letters_grad)
    return float((total - path).mean()), grads


def train(
    chars: np.ndarray, tags: np.ndarray, classes: int, n_tags: int, steps: int = 600, batch: int = 32, seed: int = 1
) -> dict[str, np.ndarray]:
    """Weights fitted to windows (window, time) and their tags, by Adam; the same input gives the same weights."""
    weights = new_weights(classes, n_tags, seed)
    mean, spread = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    rng, order = np.random.default_rng(seed), np.empty(0, np.int64)
    for step in range(1, steps + 1 if len(chars) else 1):
        if not len(order):
            order = rng.permutation(len(chars))
        own, order = order[:batch], order[batch:]
        _, grads = gradients(weights, chars[own].T, tags[own].T)
        size = np.sqrt(sum((g**2).sum() for g in grads.values()))
        rate = 0.02 * min(1.0, 2 - 2 * step / (steps + 1)) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        for name, grad in grads.items():
            grad = grad / max(1.0, size / 5)
            mean[name] = 0.9 * mean[name] + 0.1 * grad
            spread[name] = 0.99 * spread[name] + 0.01 * grad**2
            weights[name] = weights[name] - rate * mean[name] / (np.sqrt(spread[name]) + 1e-8)
    return weights


def decode(weights: dict[str, np.ndarray], chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tag path of each window (window, time) and the probability of each of its tags."""
    emitted = scores(weights, chars.T)
    ahead, behind, total = _sums(weights, emitted)
    share = np.exp(ahead + behind - total[:, None])
    best, back = weights["begin"] + emitted[0], np.empty(emitted.shape, np.int64)
    for t in range(1, len(emitted)):
        ways = best[:, :, None] + weights["move"]
        back[t] = ways.argmax(1)
        best = ways.max(1) + emitted[t]
    path, windows = np.empty(emitted.shape[:2], np.int64), np.arange(chars.shape[0])
    path[-1] = best.argmax(1)
    for t in range(len(path) - 1, 0, -1):
        path[t - 1] = back[t, windows, path[t]]
    return path.T, np.take_along_axis(share, path[:, :, None], 2)[:, :, 0].T
