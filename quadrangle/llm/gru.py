"""A bidirectional gated recurrent network over bytes, in numpy.

Every byte looks up its gate inputs in a table; two recurrences of `HIDDEN` units run
forwards and backwards; each position gets a probability for every label. Training is
backpropagation through time with Adam.
"""

import numpy as np

HIDDEN = 8
EDGE = 12


def initial(labels, hidden=HIDDEN, seed=5):
    rng = np.random.default_rng(seed)
    p = {}
    for way in "fb":
        p["w" + way] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        p["u" + way] = (rng.normal(0, 1, (hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
    p["o"] = rng.normal(0, 0.3, (2 * hidden, labels)).astype(np.float32)
    p["c"] = np.zeros(labels, np.float32)
    return p


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _recur(w, u, data, mask, order, trace=None):
    """States at every position; `data` and `mask` are (steps, rows)."""
    steps, rows = data.shape
    hidden = u.shape[0]
    h = np.zeros((rows, hidden), np.float32)
    out = np.zeros((steps, rows, hidden), np.float32)
    for t in order:
        a, v = w[data[t]], h @ u
        gates = _sigmoid(a[:, : 2 * hidden] + v[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = np.tanh(a[:, 2 * hidden :] + r * v[:, 2 * hidden :])
        new = (n + z * (h - n)) * mask[t][:, None]
        if trace is not None:
            trace[t] = (h, z, r, n, v[:, 2 * hidden :])
        h = out[t] = new
    return out


def _back(w, u, data, mask, order, trace, dout):
    """Gradients of the tables of one direction, given those of its states."""
    steps, rows = data.shape
    hidden = u.shape[0]
    du = np.zeros_like(u)
    da = np.zeros((steps, rows, 3 * hidden), np.float32)
    dh = np.zeros((rows, hidden), np.float32)
    for t in reversed(order):
        before, z, r, n, vn = trace[t]
        dh = (dh + dout[t]) * mask[t][:, None]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (before - n) * z * (1 - z)
        dr = dn * vn * r * (1 - r)
        da[t] = np.concatenate([dz, dr, dn], axis=1)
        dv = np.concatenate([dz, dr, dn * r], axis=1)
        du += before.T @ dv
        dh = dh * z + dv @ u.T
    flat, order_ = data.reshape(-1), np.argsort(data.reshape(-1), kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(flat[order_]) != 0])
    dw = np.zeros_like(w)
    dw[flat[order_][cuts]] = np.add.reduceat(da.reshape(-1, 3 * hidden)[order_], cuts, axis=0)
    return dw, du


def log_probabilities(p, data, mask):
    """Log probability of each label at every position: (steps, rows, labels)."""
    order = range(len(data))
    f = _recur(p["wf"], p["uf"], data, mask, order)
    b = _recur(p["wb"], p["ub"], data, mask, order[::-1])
    hidden = f.shape[2]
    y = f @ p["o"][:hidden] + b @ p["o"][hidden:] + p["c"]
    y -= y.max(axis=2, keepdims=True)
    return y - np.log(np.exp(y).sum(axis=2, keepdims=True))


def _halved(w, u):
    """Tables of one direction for `_states`: gates apart from the rest, factors of one half taken in."""
    hidden = u.shape[0]
    gates, rest = slice(0, 2 * hidden), slice(2 * hidden, None)
    return [np.ascontiguousarray(x, np.float32) for x in (w[:, gates] / 2, w[:, rest], u[:, gates] / 2, u[:, rest] / 2)]


def _states(w, u, data, mask, order):
    """As `_recur`, for reading only: with s = tanh(x / 2) a gate is (1 + s) / 2, every step
    works in the same few buffers, and steps where all rows are inside skip the mask."""
    wg, wn, ug, un = _halved(w, u)
    steps, rows = data.shape
    hidden = len(ug)
    out = np.empty((steps, rows, hidden), np.float32)
    gates, g, n, v = (np.empty((rows, k * hidden), np.float32) for k in (2, 2, 1, 1))
    z, r = gates[:, :hidden], gates[:, hidden:]
    h, whole = np.zeros((rows, hidden), np.float32), mask.all(axis=1)
    for t in order:
        np.take(wg, data[t], axis=0, out=gates, mode="clip")
        gates += np.matmul(h, ug, out=g)
        np.tanh(gates, out=gates)
        gates += 1
        np.matmul(h, un, out=v)
        v *= r
        np.take(wn, data[t], axis=0, out=n, mode="clip")
        n += v
        np.tanh(n, out=n)
        np.subtract(h, n, out=v)
        v *= z
        v *= 0.5
        np.add(n, v, out=out[t])
        h = out[t]
        if not whole[t]:
            h *= mask[t][:, None]
    return out


def probabilities(p, data, mask):
    """Probability of each label at every position: (steps, rows, labels)."""
    order = range(len(data))
    f = _states(p["wf"], p["uf"], data, mask, order)
    b = _states(p["wb"], p["ub"], data, mask, order[::-1])
    hidden = f.shape[2]
    y = f @ p["o"][:hidden]
    y += b @ p["o"][hidden:]
    y += p["c"]
    y -= y.max(axis=2, keepdims=True)
    np.exp(y, out=y)
    y /= y.sum(axis=2, keepdims=True)
    return y


def loss_and_gradients(p, data, mask, label):
    """Mean cross-entropy over positions, and its gradients."""
    order = range(len(data))
    tf, tb = {}, {}
    f = _recur(p["wf"], p["uf"], data, mask, order, tf)
    b = _recur(p["wb"], p["ub"], data, mask, order[::-1], tb)
    both = np.concatenate([f, b], axis=2)
    y = both @ p["o"] + p["c"]
    y -= y.max(axis=2, keepdims=True)
    logs = y - np.log(np.exp(y).sum(axis=2, keepdims=True))
    share = mask / mask.sum()
    rows = np.arange(data.shape[1])
    loss = -(logs[:, rows, label] * share).sum()
    dy = np.exp(logs)
    dy[:, rows, label] -= 1
    dy *= share[:, :, None]
    g = {"o": np.einsum("tnh,tnl->hl", both, dy), "c": dy.sum(axis=(0, 1))}
    dboth = dy @ p["o"].T
    hidden = f.shape[2]
    g["wf"], g["uf"] = _back(p["wf"], p["uf"], data, mask, order, tf, dboth[:, :, :hidden])
    g["wb"], g["ub"] = _back(p["wb"], p["ub"], data, mask, order[::-1], tb, dboth[:, :, hidden:])
    return loss, g


def fit(windows, labels, classes, steps=400, batch=128, rate=0.02, seed=9):
    """Parameters trained on byte strings `windows` with class numbers `labels`."""
    width = max(map(len, windows))
    data = np.zeros((width, len(windows)), np.uint8)
    mask = np.zeros((width, len(windows)), np.float32)
    for i, window in enumerate(windows):
        data[: len(window), i] = np.frombuffer(window, np.uint8)
        mask[: len(window), i] = 1
    labels, rng = np.asarray(labels), np.random.default_rng(seed)
    p = initial(classes)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    by_class = [np.flatnonzero(labels == c) for c in range(classes)]
    for step in range(1, steps + 1):
        picked = rng.integers(0, classes, batch)
        rows = np.array([by_class[c][rng.integers(0, len(by_class[c]))] for c in picked])
        _, g = loss_and_gradients(p, data[:, rows], mask[:, rows], labels[rows])
        now = rate * min(1, 2 * (1 - step / (steps + 1)))
        for k in p:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
            p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p


def segments(data, offsets, length, block):
    """Texts as (bytes, mask, weight, row) blocks of `block` segments of `length` bytes.

    Each segment also shows up to `EDGE` bytes before and after it; `weight` marks the
    letters of the segment itself, so that every byte of a text counts once."""
    sizes = np.diff(offsets)
    many = -(-sizes // length)
    rows = np.repeat(np.arange(len(sizes)), many)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
    begin = offsets[rows] + nth * length
    stop = np.minimum(begin + length, offsets[rows + 1])
    order = np.argsort(begin - stop, kind="stable")
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = letter[128:] = True
    for lo in range(0, len(order), block):
        pick = order[lo : lo + block]
        wide = int((stop[pick] - begin[pick]).max()) + 2 * EDGE
        at = begin[pick] - EDGE + np.arange(wide)[:, None]
        inside = (at >= offsets[rows[pick]]) & (at < offsets[rows[pick] + 1])
        seen = data[np.where(inside, at, begin[pick])]
        own = (at >= begin[pick]) & (at < stop[pick])
        yield seen, inside.astype(np.float32), own & letter[seen], rows[pick]


def pooled(p, data, offsets, length=256, block=2048):
    """Mean label probabilities over the letters of each text, and the letter bytes counted."""
    n, classes = len(offsets) - 1, len(p["c"])
    total, count = np.zeros((n, classes)), np.zeros(n, np.int64)
    for seen, inside, weight, rows in segments(data, offsets, length, block):
        own = np.einsum("tnl,tn->nl", probabilities(p, seen, inside), weight.astype(np.float32))
        np.add.at(total, rows, own)
        np.add.at(count, rows, weight.sum(axis=0))
    return total / np.maximum(count, 1)[:, None], count
