"""A small causal self-attention model in numpy: tables, forward and backward pass, training on windows, scoring.

The model predicts the class of the next subword id, then the id inside its class:

    p(x | context) = softmax(out(h) + bias[previous id])[class of x] * inside[previous id, x]

``bias`` and ``inside`` come from counts over the whole training corpus (``prior``); ``h`` is one layer of causal self-attention
over the window with relative-position biases and a hidden layer, trained by gradient descent. With untrained weights the
model is the corpus's bigram model. Ids outside the ``HEAD`` most frequent ones share one class, inside which they follow
their corpus frequency, so every id has a positive probability and all probabilities of a context add up to one.
"""

from __future__ import annotations

import numpy as np

WINDOW = 64
STRIDE = 32
HEAD = 2048
CLASSES = 64
DIM, KEY, HIDDEN = 32, 16, 64
NEVER = np.float32(-1e9)


def prior(pair: np.ndarray, n: np.ndarray, vocab: int, end: int, head: int = HEAD, classes: int = CLASSES, strength: float = 4.0) -> dict[str, np.ndarray]:
    """Tables from bigram counts: ``pair`` is previous * 65536 + next. ``end`` opens and closes every text.

    ``slot``: id -> place among the head ids, the last place for all others; one more place pads windows.
    """
    prev, cur = pair >> 16, pair & 0xFFFF
    uni = np.bincount(cur, weights=n, minlength=vocab)
    order = np.lexsort((np.arange(vocab), -uni))
    top = np.sort(np.unique(np.append(order[: head - 2], end)))
    slot = np.full(vocab, len(top), np.int32)
    slot[top] = np.arange(len(top))
    k = len(top) + 1
    table = np.zeros((k, k))
    np.add.at(table, (slot[prev], slot[cur]), n)
    rare = slot == k - 1
    tail = np.where(rare, uni + 1, 0)
    tail_log = np.where(rare, np.log(np.maximum(tail, 1e-300) / max(tail.sum(), 1)), 0)
    group = _classes(table[:, : k - 1], classes - 1)
    group = np.append(group, group.max() + 1)  # the rare ids are a class of their own
    c = int(group.max()) + 1
    member = np.zeros((k, c))
    member[np.arange(k), group] = 1
    uni_slot = np.bincount(slot, weights=uni, minlength=k) + 0.5
    uni_class = uni_slot @ member
    by_class = table @ member
    total = table.sum(1, keepdims=True)
    bias = (by_class + strength * uni_class / uni_class.sum()) / (total + strength)
    inside = (table + strength * (uni_slot / uni_class[group])[None]) / (by_class + strength)[:, group]
    pad = np.zeros((1, c))
    return {
        "slot": slot,
        "group": group.astype(np.int32),
        "tail": tail_log.astype(np.float32),
        "bias": np.concatenate([np.log(bias), pad]).astype(np.float32),
        "inside": np.log(inside).astype(np.float32),
        "end": np.array(end),
    }


def _classes(table: np.ndarray, classes: int, rounds: int = 15) -> np.ndarray:
    """Ids with similar neighbours on both sides: a random-projection sketch of both count tables, then k-means."""
    rng = np.random.default_rng(3)
    k = table.shape[1]
    square = table[:k]
    feats = []
    for m in (square, square.T):
        p = np.sqrt(m / np.maximum(m.sum(1, keepdims=True), 1))
        basis = np.linalg.qr(p @ rng.standard_normal((k, 40)))[0]
        basis = np.linalg.qr(p @ (p.T @ basis))[0]
        feats.append(p @ (p.T @ basis))
    x = np.concatenate(feats, 1)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    weight = np.sqrt(table.sum(0) + 1)
    classes = min(classes, k)
    centre = x[np.argsort(-weight, kind="stable")[:classes]]
    for _ in range(rounds):
        own = (x @ centre.T).argmax(1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, x * weight[:, None])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centre)
    return np.unique((x @ centre.T).argmax(1), return_inverse=True)[1]


def init(tables: dict[str, np.ndarray], seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    k, c = tables["bias"].shape
    normal = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    return {
        "e": (0.5 * rng.standard_normal((k, DIM))).astype(np.float32),
        "wq": normal(DIM, KEY),
        "wk": normal(DIM, KEY),
        "wv": normal(DIM, DIM),
        "w1": normal(DIM, HIDDEN),
        "w2": normal(DIM, HIDDEN),
        "b": np.zeros(HIDDEN, np.float32),
        "out": np.zeros((HIDDEN, c), np.float32),
        "rel": np.zeros(WINDOW, np.float32),
    }


def windows(slots: np.ndarray, starts: np.ndarray, ends: np.ndarray, pad: int) -> np.ndarray:
    """Rows of WINDOW slots for texts ``slots[start:end]``: each STRIDE inputs once in the right half, context on the left."""
    per = -(-(ends - starts) // STRIDE)
    total = int(per.sum())
    text = np.repeat(np.arange(len(starts)), per)
    first = starts[text] + (np.arange(total) - np.repeat(np.cumsum(per) - per, per)) * STRIDE
    at = first[:, None] + np.arange(-STRIDE, STRIDE)[None]
    ok = (at >= starts[text, None]) & (at < ends[text, None])
    return np.where(ok, slots[np.clip(at, 0, max(len(slots) - 1, 0))], pad)


def _pairs(x: np.ndarray) -> np.ndarray:
    """Every block with the one before it, without a copy: (n + 1, STRIDE, d) -> (n, WINDOW, d)."""
    x = np.ascontiguousarray(x)
    shape = (len(x) - 1, 2 * x.shape[1], x.shape[2])
    return np.lib.stride_tricks.as_strided(x, shape, (x.strides[0], x.strides[1], x.strides[2]), writeable=False)


_QUERY = np.arange(STRIDE)[:, None] + STRIDE
_DIST = _QUERY - np.arange(WINDOW)[None]  # how far back a key lies; negative: in the future


def _exp(x: np.ndarray, most: float) -> None:
    """``exp(min(x, most))`` in place."""
    if x.max() > most:
        np.minimum(x, most, out=x)
    np.exp(x, out=x)


class Runner:
    """The model with its per-id projections worked out."""

    def __init__(self, params: dict[str, np.ndarray], tables: dict[str, np.ndarray]):
        p = self.p = params
        self.t = tables
        self.q = (p["e"] @ p["wq"]) * np.float32(KEY**-0.5)
        self.k, self.v = p["e"] @ p["wk"], p["e"] @ p["wv"]
        self.own = p["e"] @ p["w2"] + p["b"]
        self.mask = np.where(_DIST >= 0, p["rel"][np.clip(_DIST, 0, WINDOW - 1)], NEVER).astype(np.float32)
        self.pad = len(p["e"]) - 1

    def attend(self, w: np.ndarray, q: np.ndarray, k: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights, their sums and the output of attention in windows ``w``, whose queries, keys and values are given; padding is never attended to."""
        s = np.matmul(q, k.transpose(0, 2, 1))
        s += self.mask
        padded = np.flatnonzero(w[:, 0] == self.pad)  # only a text's first windows have padding on the left
        if len(padded):
            s[padded] += np.where(w[padded] == self.pad, NEVER, np.float32(0))[:, None, :]
            s[padded] = np.maximum(s[padded], NEVER)
        _exp(s, 60)
        total = s.sum(-1, keepdims=True)
        o = np.matmul(s, v)
        o /= np.maximum(total, 1e-30)
        return s, total, o

    def logits(self, mine: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hid = o.reshape(-1, DIM) @ self.p["w1"]
        hid += np.take(self.own, mine.reshape(-1), axis=0)
        np.maximum(hid, 0, out=hid)
        z = hid @ self.p["out"]
        z += np.take(self.t["bias"], mine.reshape(-1), axis=0)
        return hid, z

    def class_logs(self, blocks: np.ndarray, target_class: np.ndarray, at_once: int = 48) -> np.ndarray:
        """Natural-log probability of the class after each input of ``blocks``, which lie in the order of the texts.

        A window is a block and the one before it; a text's first block follows one of padding. So a block's keys and values are
        looked up once for the two windows that hold it.
        """
        out = np.zeros((len(blocks), STRIDE), np.float32)
        value = np.concatenate([self.v, np.ones((len(self.v), 1), np.float32)], 1)  # the last column of the product sums the weights
        # padding has weight 0: its row of values is 0, the one of the sum included
        value[self.pad] = 0
        safe = float(np.linalg.norm(self.q, axis=1).max() * np.linalg.norm(self.k, axis=1).max() + self.p["rel"].max()) < 60
        ones = np.ones(self.p["out"].shape[1], np.float32)
        for lo in range(1, len(blocks), at_once):
            part = blocks[lo - 1 : lo + at_once]
            mine = part[1:]
            k, v = _pairs(np.take(self.k, part, axis=0)), _pairs(np.take(value, part, axis=0))
            s = np.matmul(np.take(self.q, mine, axis=0), k.transpose(0, 2, 1))
            s += self.mask
            if not safe:
                np.minimum(s, 60, out=s)
            np.exp(s, out=s)
            o = np.matmul(s, v)
            o = o[..., :DIM] / np.maximum(o[..., DIM:], 1e-30)
            _, z = self.logits(mine, o)
            want = z[np.arange(len(z)), target_class[lo : lo + len(mine)].reshape(-1)]
            np.exp(z, out=z)
            out[lo : lo + len(mine)] = (want - np.log(z @ ones)).reshape(-1, STRIDE)
        return out

    def texts(self, ids: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each id sequence, its end included."""
        t = self.t
        end = int(t["end"])
        lens = np.fromiter(map(len, ids), np.int64, len(ids)) + 1  # predictions of a text
        flat = np.concatenate([x for one in ids for x in (one, [end])]).astype(np.int64)
        target = t["slot"][flat]
        ends = np.cumsum(lens)
        starts = ends - lens
        inputs = np.empty_like(target)
        inputs[1:] = target[:-1]
        inputs[starts] = t["slot"][end]
        fine = np.take(t["inside"].reshape(-1), inputs.astype(np.int64) * t["inside"].shape[1] + target)
        if (target == t["inside"].shape[1] - 1).any():  # ids outside the head
            fine = fine + t["tail"][flat]
        per = -(-lens // STRIDE) + 1  # a block of padding, then the text's own
        row = np.repeat((np.cumsum(per) - per + 1) * STRIDE - starts, lens) + np.arange(len(flat))
        blocks = np.full(int(per.sum()) * STRIDE, self.pad, np.int32)
        blocks[row] = inputs
        classes = np.zeros(len(blocks), np.int32)
        classes[row] = t["group"][target]
        coarse = self.class_logs(blocks.reshape(-1, STRIDE), classes.reshape(-1, STRIDE)).reshape(-1)[row]
        return np.add.reduceat(fine.astype(np.float64) + coarse, starts) / np.log(10)


def _by_id(x: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The rows of ``x`` summed by ``ids``, of ``n``."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")  # by digits
    times = np.bincount(ids, minlength=n)
    there = np.flatnonzero(times)
    out = np.zeros((n, x.shape[1]), x.dtype)
    out[there] = np.add.reduceat(np.take(x, order, axis=0), (np.cumsum(times) - times)[there], axis=0)
    return out


def gradients(params: dict[str, np.ndarray], tables: dict[str, np.ndarray], w: np.ndarray, classes: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the right-half predictions with ``classes`` >= 0, and its gradient.

    The model is cut down to the ids of the batch first, so a step's work does not grow with the ids there are.
    """
    seen = np.zeros(len(params["e"]), bool)
    seen[w] = True
    seen[-1] = True  # padding is the last of the ids here too
    ids = np.flatnonzero(seen)
    w = np.take(np.cumsum(seen) - 1, w)
    mine = np.ascontiguousarray(w[:, STRIDE:])
    own, flat_w = mine.reshape(-1), w.reshape(-1)
    p = params | {"e": params["e"][ids]}
    r = Runner(p, {"bias": tables["bias"][ids]})
    e_own, e_all = np.take(p["e"], own, axis=0), np.take(p["e"], flat_w, axis=0)
    q, k, v = np.take(r.q, mine, axis=0), np.take(r.k, w, axis=0), np.take(r.v, w, axis=0)
    s, total, o = r.attend(w, q, k, v)
    hid, z = r.logits(mine, o)
    _exp(z, 80)
    z /= z @ np.ones((z.shape[1], 1), z.dtype)
    flat = classes.reshape(-1)
    valid = flat >= 0
    count = max(1, int(valid.sum()))
    at = np.flatnonzero(valid)
    right = at * z.shape[1] + flat[at]
    chance = np.take(z, right)
    loss = -float(np.log(np.maximum(chance, 1e-30)).sum()) / count
    np.put(z, right, chance - 1)
    z *= (valid / count).astype(z.dtype)[:, None]
    g = {"out": hid.T @ z}
    dh = z @ p["out"].T
    dh *= hid > 0
    g["w1"] = o.reshape(-1, DIM).T @ dh
    g["w2"] = e_own.T @ dh
    g["b"] = dh.sum(0)
    d_own = dh @ p["w2"].T
    do = (dh @ p["w1"].T).reshape(o.shape)
    s /= np.maximum(total, 1e-30)
    ds = np.matmul(do, v.transpose(0, 2, 1))
    ds -= (ds * s).sum(-1, keepdims=True)
    ds *= s
    dv = np.matmul(s.transpose(0, 2, 1), do).reshape(-1, DIM)
    dq = np.matmul(ds, k).reshape(-1, KEY)
    dq *= np.float32(KEY**-0.5)
    dk = np.matmul(ds.transpose(0, 2, 1), q).reshape(-1, KEY)
    by_place = ds.sum(0)
    back = _DIST >= 0
    g["rel"] = np.bincount(_DIST[back], weights=by_place[back], minlength=WINDOW).astype(np.float32)
    g["wq"], g["wk"], g["wv"] = e_own.T @ dq, e_all.T @ dk, e_all.T @ dv
    d_own += dq @ p["wq"].T
    d_all = dk @ p["wk"].T
    d_all += dv @ p["wv"].T
    d_all.reshape(len(w), WINDOW, DIM)[:, STRIDE:] += d_own.reshape(len(w), STRIDE, DIM)
    g["e"] = np.zeros_like(params["e"])
    g["e"][ids] = _by_id(d_all, flat_w, len(ids))
    return loss, g


def train(params: dict[str, np.ndarray], tables: dict[str, np.ndarray], rows: np.ndarray, rate: float, batch: int = 64, seed: int = 0) -> tuple[dict[str, np.ndarray], float]:
    """One Adam pass over ``rows`` (windows of ids, one id longer than WINDOW; -1 pads both ends)."""
    names = list(params)
    cuts = np.cumsum([0, *(params[k].size for k in names)])
    flat = np.concatenate([params[k].reshape(-1) for k in names])
    p = {k: flat[a:b].reshape(params[k].shape) for k, a, b in zip(names, cuts, cuts[1:])}
    m, s, up, down = (np.zeros_like(flat) for _ in range(4))
    slots = np.where(rows >= 0, tables["slot"][rows], len(p["e"]) - 1)
    target = np.where(rows[:, STRIDE + 1 :] >= 0, tables["group"][np.minimum(slots[:, STRIDE + 1 :], len(tables["group"]) - 1)], -1)
    losses = []
    for step, at in enumerate(np.array_split(np.random.default_rng(seed).permutation(len(rows)), max(1, len(rows) // batch)), 1):
        loss, g = gradients(p, tables, slots[at, :WINDOW], target[at])
        losses.append(loss)
        for k, a, b in zip(names, cuts, cuts[1:]):
            up[a:b] = g[k].reshape(-1)
        np.multiply(up, 0.01, out=down)
        down *= up
        s *= 0.99
        s += down
        up *= 0.1
        m *= 0.9
        m += up
        np.divide(s, 1 - 0.99**step, out=down)
        np.sqrt(down, out=down)
        down += 1e-6
        np.divide(m, 1 - 0.9**step, out=up)
        up *= rate
        up /= down
        flat -= up
    return p, float(np.mean(losses))
