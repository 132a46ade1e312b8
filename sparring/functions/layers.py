"""The few network layers the trainers need, as numpy steps over one mini-batch inside a task.

A layer is a tuple `(kind, options...)`. Each kind has three functions: shapes of its
parameters, a forward step returning the output and what the backward step needs, and a backward
step returning the input gradient and the parameter gradients.
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

Shape = tuple[int, ...]


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _glorot(rng, fan_in: int, fan_out: int, shape: Shape):
    limit = np.sqrt(6.0 / (fan_in + fan_out))
    return rng.uniform(-limit, limit, shape)


# --- sequence and flatten: only change the shape ---


def _reshape_forward(_, layer, x):
    return (x[:, :, None] if layer[0] == "sequence" else x.reshape(len(x), -1)), x.shape


def _reshape_backward(_, layer, shape, dy):
    return dy.reshape(shape), []


# --- dense and relu ---


def _dense_init(rng, layer, shape: Shape):
    width, units = shape[-1], layer[1]
    return [_glorot(rng, width, units, (width, units)), np.zeros(units)], (units,)


def _dense_forward(params, layer, x):
    return x @ params[0] + params[1], x


def _dense_backward(params, layer, x, dy):
    return dy @ params[0].T, [x.T @ dy, dy.sum(0)]


def _relu_forward(_, layer, x):
    return np.maximum(x, 0), x > 0


def _relu_backward(_, layer, mask, dy):
    return dy * mask, []


# --- one-dimensional convolution with zero padding to the input length ---


def _conv_init(rng, layer, shape: Shape):
    _, filters, kernel = layer
    steps, channels = shape
    weights = _glorot(rng, kernel * channels, kernel * filters, (channels * kernel, filters))
    return [weights, np.zeros(filters)], (steps, filters)


def _conv_forward(params, layer, x):
    kernel = layer[2]
    left = (kernel - 1) // 2
    padded = np.pad(x, ((0, 0), (left, kernel - 1 - left), (0, 0)))
    windows = sliding_window_view(padded, kernel, axis=1).reshape(x.shape[0], x.shape[1], -1)
    return windows @ params[0] + params[1], (windows, x.shape)


def _conv_backward(params, layer, tape, dy):
    windows, (n, steps, channels) = tape
    kernel = layer[2]
    left = (kernel - 1) // 2
    flat = dy.reshape(-1, dy.shape[2])
    dw = windows.reshape(flat.shape[0], -1).T @ flat
    spread = (dy @ params[0].T).reshape(n, steps, channels, kernel)
    padded = np.zeros((n, steps + kernel - 1, channels), dtype=dy.dtype)
    for k in range(kernel):
        padded[:, k : k + steps] += spread[..., k]
    return padded[:, left : left + steps], [dw, flat.sum(0)]


# --- max pooling over non-overlapping windows; an incomplete last window is dropped ---


def _pool_shape(rng, layer, shape: Shape):
    return [], (shape[0] // layer[1], shape[1])


def _pool_forward(_, layer, x):
    size = layer[1]
    steps = x.shape[1] // size
    windows = x[:, : steps * size].reshape(len(x), steps, size, -1)
    best = windows.argmax(2)[:, :, None]
    return np.take_along_axis(windows, best, 2)[:, :, 0], (best, x.shape)


def _pool_backward(_, layer, tape, dy):
    best, shape = tape
    size = layer[1]
    windows = np.zeros((shape[0], best.shape[1], size, shape[2]), dtype=dy.dtype)
    np.put_along_axis(windows, best, dy[:, :, None], 2)
    dx = np.zeros(shape, dtype=dy.dtype)
    dx[:, : best.shape[1] * size] = windows.reshape(shape[0], -1, shape[2])
    return dx, []


# --- LSTM returning its last state; gates in the order input, forget, cell, output ---


def _lstm_init(rng, layer, shape: Shape):
    channels, units = shape[1], layer[1]
    recurrent = np.linalg.qr(rng.normal(size=(4 * units, units)))[0].T
    bias = np.zeros(4 * units)
    bias[units : 2 * units] = 1.0
    return [_glorot(rng, channels, 4 * units, (channels, 4 * units)), recurrent, bias], (units,)


def _lstm_forward(params, layer, x):
    w, u, b = params
    units = layer[1]
    h = c = np.zeros((len(x), units), dtype=x.dtype)
    tape = []
    for t in range(x.shape[1]):
        z = x[:, t] @ w + h @ u + b
        i, f, o = (_sigmoid(z[:, k * units : (k + 1) * units]) for k in (0, 1, 3))
        g = np.tanh(z[:, 2 * units : 3 * units])
        h_before, c_before = h, c
        c = f * c + i * g
        tanh_c = np.tanh(c)
        h = o * tanh_c
        tape.append((h_before, c_before, i, f, g, o, tanh_c))
    return h, (x, tape)


def _lstm_backward(params, layer, saved, dh):
    w, u, _ = params
    x, tape = saved
    dw, du, db = np.zeros_like(w), np.zeros_like(u), 0.0
    dx = np.empty_like(x)
    dc = np.zeros_like(dh)
    for t in reversed(range(x.shape[1])):
        h_before, c_before, i, f, g, o, tanh_c = tape[t]
        dc = dc + dh * o * (1 - tanh_c**2)
        dz = np.concatenate(
            [dc * g * i * (1 - i), dc * c_before * f * (1 - f), dc * i * (1 - g**2), dh * tanh_c * o * (1 - o)], 1
        )
        dw += x[:, t].T @ dz
        du += h_before.T @ dz
        db = db + dz.sum(0)
        dx[:, t] = dz @ w.T
        dh = dz @ u.T
        dc = dc * f
    return dx, [dw, du, db]


_NO_PARAMS = {
    "sequence": lambda shape: (*shape, 1),
    "flatten": lambda shape: (int(np.prod(shape)),),
    "relu": lambda shape: shape,
}
_INIT = {"dense": _dense_init, "conv": _conv_init, "pool": _pool_shape, "lstm": _lstm_init}
_STEPS = {
    "sequence": (_reshape_forward, _reshape_backward),
    "flatten": (_reshape_forward, _reshape_backward),
    "dense": (_dense_forward, _dense_backward),
    "relu": (_relu_forward, _relu_backward),
    "conv": (_conv_forward, _conv_backward),
    "pool": (_pool_forward, _pool_backward),
    "lstm": (_lstm_forward, _lstm_backward),
}


def initial_params(layers, n_features: int, seed: int) -> list[list[np.ndarray]]:
    rng = np.random.default_rng(seed)
    shape: Shape = (n_features,)
    params = []
    for layer in layers:
        if layer[0] in _NO_PARAMS:
            made, shape = [], _NO_PARAMS[layer[0]](shape)
        else:
            made, shape = _INIT[layer[0]](rng, layer, shape)
        params.append([p.astype(np.float32) for p in made])
    return params


def forward(layers, params, x):
    tapes = []
    for layer, own in zip(layers, params):
        x, tape = _STEPS[layer[0]][0](own, layer, x)
        tapes.append(tape)
    return x, tapes


def backward(layers, params, tapes, grad) -> list[list[np.ndarray]]:
    grads = []
    for layer, own, tape in zip(reversed(layers), reversed(params), reversed(tapes)):
        grad, own_grads = _STEPS[layer[0]][1](own, layer, tape, grad)
        grads.append(own_grads)
    return grads[::-1]


def loss_and_grad(kind: str, out: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss of a mini-batch and the gradient of its mean; `out` is before the activation."""
    n = len(y)
    if kind == "squared":
        diff = out[:, 0] - y
        return float((diff**2).sum()), (2.0 / n * diff)[:, None]
    if kind == "binary":
        z = out[:, 0]
        total = (np.logaddexp(0, z) - y * z).sum()
        return float(total), ((_sigmoid(z) - y) / n)[:, None]
    shifted = out - out.max(1, keepdims=True)
    log_p = shifted - np.log(np.exp(shifted).sum(1, keepdims=True))
    rows = np.arange(n)
    index = y.astype(int)
    grad = np.exp(log_p)
    grad[rows, index] -= 1
    return float(-log_p[rows, index].sum()), grad / n


def activate(kind: str, out: np.ndarray) -> np.ndarray:
    """Network output as predictions (`squared`) or one probability column per class."""
    if kind == "squared":
        return out[:, 0]
    if kind == "binary":
        p = _sigmoid(out[:, 0])
        return np.stack([1 - p, p], 1)
    e = np.exp(out - out.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class Adam:
    """Adam with its usual constants; moments live for one local pass."""

    BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-7

    def __init__(self, params, rate: float):
        self.rate, self.step = rate, 0
        self.moments = [[(np.zeros_like(p), np.zeros_like(p)) for p in own] for own in params]

    def update(self, params, grads, decay: float = 0.0) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - self.BETA2**self.step) / (1 - self.BETA1**self.step)
        for own, own_grads, own_moments in zip(params, grads, self.moments):
            for p, g, (m, v) in zip(own, own_grads, own_moments):
                if decay and p.ndim > 1:
                    g = g + decay * p
                m += (1 - self.BETA1) * (g - m)
                v += (1 - self.BETA2) * (g * g - v)
                p -= scale * m / (np.sqrt(v) + self.EPSILON)


def flatten(params) -> np.ndarray:
    return np.concatenate([p.ravel() for own in params for p in own]).astype(np.float64)


def unflatten(flat: np.ndarray, like) -> list[list[np.ndarray]]:
    out, at = [], 0
    for own in like:
        fresh = []
        for p in own:
            fresh.append(np.asarray(flat[at : at + p.size], dtype=np.float32).reshape(p.shape).copy())
            at += p.size
        out.append(fresh)
    return out
