"""A small gated recurrent language model with a class-factored softmax and binary trees of the rarer words, in numpy."""

from __future__ import annotations

import heapq

import numpy as np

#: Sizes: embedding, state, words of a softmax class, lanes run side by side, window.
EMBED, STATE, PER_CLASS, LANES, WINDOW = 16, 16, 32, 1024, 16


class Shape:
    """How many inputs, word classes, other classes and ranked words a model has.

    Words are ranked by falling count. The first ones, PER_CLASS for each word class, are
    guessed by the softmax of their class. Each further one is a leaf of the binary tree of
    its band, a band being the ranks from a power of two to the next; a node of a tree turns
    left or right by the state. Node k of the band from 2^n has the row 2^n + k of T, the root
    being 1. An input word is its own row of E and the row of G that its band shares.
    """

    def __init__(self, inputs: int, word_classes: int, other_classes: int, ranked: int = 0):
        self.inputs, self.word_classes, self.classes = inputs, word_classes, word_classes + other_classes
        self.single = word_classes * PER_CLASS
        self.ranked = ranked
        self.nodes = 1 << (ranked - 1).bit_length() if ranked > self.single else 0
        self.parts = {
            "G": (1 + int(self.group(np.array([inputs])).max()), EMBED),
            "W": (EMBED, 3 * STATE),
            "U": (STATE, 3 * STATE),
            "b": (3 * STATE,),
            "C": (STATE, self.classes),
            "c": (self.classes,),
            "V": (word_classes, PER_CLASS, STATE),
            "v": (word_classes, PER_CLASS),
            # parts of which a window touches few rows; the last number of a node is its bias
            "E": (inputs, EMBED),
            "T": (self.nodes, STATE + 1),
        }
        self.size = sum(int(np.prod(s)) for s in self.parts.values())
        self.dense = self.size - inputs * EMBED - self.nodes * (STATE + 1)

    def group(self, rows: np.ndarray) -> np.ndarray:
        """The row of G for rows of E."""
        return np.where(rows < self.single, 0, 1 + np.log2(np.maximum(rows, self.single) / self.single).astype(np.int64))

    def views(self, flat: np.ndarray, dense: bool = False) -> dict[str, np.ndarray]:
        """The parameters as parts of one flat vector, or of the dense ones alone."""
        found, at = {}, 0
        for name, shape in self.parts.items():
            if dense and name in "ET":
                continue
            n = int(np.prod(shape))
            found[name] = flat[at : at + n].reshape(shape)
            at += n
        return found

    def start(self, class_log: np.ndarray, word_log: np.ndarray, count: np.ndarray | None = None, seed: int = 11) -> np.ndarray:
        """Small random weights; the biases give the frequencies of classes and words.

        count is of the ranked words; those in trees begin with what their band shares.
        """
        flat = np.zeros(self.size, dtype=np.float32)  # nodes begin as 0
        drawn = flat[: self.size - self.nodes * (STATE + 1)]
        np.random.default_rng(seed).standard_normal(out=drawn, dtype=np.float32)
        drawn *= 0.1
        p = self.views(flat)
        p["b"][:] = 0
        p["c"][:] = class_log
        p["v"][:] = word_log
        band = self.single
        while self.nodes and count is not None and band < len(count):
            mass = np.zeros(2 * band)
            leaves = count[band : 2 * band]
            mass[band : band + len(leaves)] = leaves
            level = band
            while level > 1:
                half = level >> 1
                mass[half:level] = mass[level : 2 * level : 2] + mass[level + 1 : 2 * level : 2]
                level = half
            left, right = mass[2::2], mass[3::2]
            p["T"][band + 1 : 2 * band, STATE] = np.clip(np.log((right + 1e-9) / (left + 1e-9)), -30, 30)
            band *= 2
        return flat


class Lanes:
    """Documents laid end to end in lanes of about equal length, longest lane first."""

    def __init__(self, lengths: list[int], lanes: int = LANES):
        lanes = max(1, min(lanes, len(lengths)))
        heap = [(0, k) for k in range(lanes)]
        own: list[list[int]] = [[] for _ in range(lanes)]
        for doc in sorted(range(len(lengths)), key=lambda d: -lengths[d]):
            load, k = heapq.heappop(heap)
            own[k].append(doc)
            heapq.heappush(heap, (load + lengths[doc], k))
        totals = [sum(lengths[d] for d in docs) for docs in own]
        by_length = sorted(range(lanes), key=lambda k: -totals[k])
        self.order = [d for k in by_length for d in own[k]]  # documents in the order of the flat arrays
        self.length = np.array([totals[k] for k in by_length])
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])

    def windows(self):
        """(places, valid): places in the flat arrays of each window, time first."""
        steps = np.arange(WINDOW)[:, None]
        for at in range(0, int(self.length.max(initial=0)), WINDOW):
            active = int(np.searchsorted(-self.length, -at, side="left"))
            valid = at + steps < self.length[None, :active]
            yield np.where(valid, self.start[None, :active] + at + steps, 0), valid


def _softmax(x: np.ndarray, chosen: np.ndarray | None = None):
    """Probabilities over the rows, in place, a column being a token; or log P of one row for each token."""
    x -= x.max(axis=0)
    picked = None if chosen is None else x[chosen, np.arange(x.shape[1])]
    np.exp(x, out=x)
    total = x.sum(axis=0)
    if chosen is None:
        x *= 1 / total
        return x
    return picked - np.log(total)


def _sigmoid_of_minus(x: np.ndarray) -> None:
    """1 / (1 + exp(x)), in place; an infinite exponential gives 0."""
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


class Model:
    """Scores and learns windows of tokens; the state is carried from window to window.

    Arrays hold a feature in each row and run along the lanes, so that numpy works on long
    stretches of memory: states are (feature, time, lane).
    """

    def __init__(self, shape: Shape, flat: np.ndarray, rate: float = 1.0):
        self.shape, self.flat, self.rate = shape, np.array(flat, dtype=np.float32), rate
        self.p = shape.views(self.flat)
        self.first = np.zeros(shape.dense, dtype=np.float32)
        self.second = np.zeros(shape.dense, dtype=np.float32)
        self.seen = {name: np.ones(len(self.p[name]), dtype=np.float32) for name in ("E", "T")}
        self.steps = 0

    def _embed(self, rows: np.ndarray) -> np.ndarray:
        return self.p["E"][rows] + self.p["G"][self.shape.group(rows)]

    def states(self, inputs: np.ndarray, keep: np.ndarray, h: np.ndarray):
        """Hidden states of a window (time, lane) from h (feature, lane), and what the backward pass needs."""
        p, n = self.p, STATE
        # the gates are sigmoids of minus their inputs, and tanh(x) is 2 sigmoid(2 x) - 1
        sign = np.repeat(np.array([-1, -1, -2], dtype=self.flat.dtype), n)
        rows, at = np.unique(inputs, return_inverse=True)  # a window has fewer words than tokens
        table = np.ascontiguousarray(((self._embed(rows) @ p["W"] + p["b"]) * sign).T)
        a = np.take(table, at.ravel(), axis=1).reshape(3 * n, *inputs.shape)
        turn = np.ascontiguousarray((p["U"] * sign).T)
        past, out, fresh, drive = (np.empty((n, *inputs.shape), dtype=self.flat.dtype) for _ in range(4))
        gates = a[: 2 * n]
        for t in range(len(inputs)):
            np.multiply(h, keep[t], out=past[:, t])
            u = turn @ past[:, t]
            zr, new, h = gates[:, t], fresh[:, t], out[:, t]
            zr += u[: 2 * n]
            _sigmoid_of_minus(zr)
            drive[:, t] = u[2 * n :]
            np.multiply(zr[n:], drive[:, t], out=new)
            new += a[2 * n :, t]
            _sigmoid_of_minus(new)
            new += new
            new -= 1
            np.subtract(past[:, t], new, out=h)
            h *= zr[:n]
            h += new
        drive *= -0.5  # what the reset gate let through, without the factor of the last gate
        return out, h, (past, gates, fresh, drive)

    def _by_class(self, classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Tokens of the word classes in the order of classes, and (class, begin, end) in that order."""
        order = np.argsort(classes, kind="stable")
        edges = np.searchsorted(classes[order], np.arange(self.shape.word_classes + 1))
        spans = [(k, a, b) for k, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())) if b > a]
        return order[: edges[-1]], spans

    def _tree(self, hidden: np.ndarray, ranks: np.ndarray, scale: float | None = None):
        """Log P(word | band) of words in trees; with a scale the gradients of the states and of the nodes instead.

        Words are taken by falling rank: on each level those that still go down come first,
        and words below one node lie together.
        """
        order = np.argsort(-ranks, kind="stable")
        rank, nodes = ranks[order].astype(np.int64), self.p["T"]
        depth = np.frexp(rank)[1] - 1
        own = np.ones((len(rank), STATE + 1), dtype=self.flat.dtype)
        own[:, :STATE] = hidden[:, order].T
        last = int(np.searchsorted(-rank, -(self.shape.nodes // 2), side="right"))  # in the last band, which may not be full
        logs, back, touched, sums = np.zeros(len(rank), dtype=self.flat.dtype), np.zeros_like(own), [], []
        for level in range(int(depth.max(initial=0))):
            k = int(np.searchsorted(-depth, -level))
            down, at, mine = depth[:k] - level, rank[:k], own[:k]
            node, right = (1 << depth[:k]) + (at >> down), (at >> (down - 1)) & 1
            vector = nodes.take(node, axis=0)
            x = np.einsum("ij,ij->i", vector, mine)
            # where no word lies to the right, there is no turn
            end = min(k, last)
            sure = np.flatnonzero((at[:end] >> (down[:end] - 1) | 1) << (down[:end] - 1) >= self.shape.ranked)
            x[sure] = -np.inf
            if scale is None:
                logs[:k] -= np.log1p(np.exp(np.where(right, -x, x)))
                continue
            _sigmoid_of_minus(np.negative(x, out=x))
            x -= right
            x *= scale
            vector *= x[:, None]
            back[:k] += vector
            begins = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            touched.append(node[begins])
            sums.append(np.add.reduceat(mine * x[:, None], begins, axis=0))
        if scale is None:
            found = np.empty_like(logs)
            found[order] = logs
            return found
        found = np.empty((STATE, len(rank)), dtype=self.flat.dtype)
        found[:, order] = back[:, :STATE].T
        return found, np.concatenate(touched), np.concatenate(sums)

    def _in_trees(self, words: np.ndarray) -> np.ndarray:
        return np.flatnonzero(words >= self.shape.single) if self.shape.nodes else np.zeros(0, dtype=np.int64)

    def log_probs(self, hidden: np.ndarray, classes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Natural log of P(class) and, in word classes and trees, of P(word | class); hidden is (feature, token)."""
        p = self.p
        found = _softmax(p["C"].T @ hidden + p["c"][:, None], classes)
        order, spans = self._by_class(classes)
        own, word, inner = hidden[:, order], words[order], np.empty(len(order), dtype=self.flat.dtype)
        for k, a, b in spans:
            inner[a:b] = _softmax(p["V"][k] @ own[:, a:b] + p["v"][k][:, None], word[a:b])
        found[order] += inner
        tail = self._in_trees(words)
        if len(tail):
            found[tail] += self._tree(hidden[:, tail], words[tail])
        return found

    def gradient(self, inputs, keep, valid, classes, words, h):
        """Gradient of the mean loss of a window, by backpropagation cut at its start."""
        dense, rows, last = self._gradient(inputs, keep, valid, classes, words, h)
        grad = np.concatenate([dense, np.zeros(self.shape.size - len(dense), dtype=dense.dtype)])
        for name, (at, sums) in rows.items():
            self.shape.views(grad)[name][at] += sums
        return grad, last

    def _gradient(self, inputs, keep, valid, classes, words, h):
        """The same, but of the parts E and T only the rows touched: {part: (rows, gradients)}."""
        p, n = self.p, STATE
        grad, rows_of = np.zeros(self.shape.dense, dtype=self.flat.dtype), {}
        g = self.shape.views(grad, dense=True)
        out, last, (past, gates, fresh, drive) = self.states(inputs, keep, h)
        use = np.flatnonzero(valid.ravel())
        scale = np.float32(1 / max(1, len(use)))
        hidden, classes, words = out.reshape(n, -1)[:, use], classes.ravel()[use], words.ravel()[use]
        d = _softmax(p["C"].T @ hidden + p["c"][:, None])
        d[classes, np.arange(len(use))] -= 1
        d *= scale
        g["C"] += hidden @ d.T
        g["c"] += d.sum(axis=1)
        back = p["C"] @ d
        order, spans = self._by_class(classes)
        mine, word = hidden[:, order], words[order]
        inner = np.empty_like(mine)
        for k, a, b in spans:
            own = mine[:, a:b]
            d = _softmax(p["V"][k] @ own + p["v"][k][:, None])
            d[word[a:b], np.arange(b - a)] -= 1
            d *= scale
            g["V"][k] += d @ own.T
            g["v"][k] += d.sum(axis=1)
            inner[:, a:b] = p["V"][k].T @ d
        back[:, order] += inner
        tail = self._in_trees(words)
        if len(tail):
            states, *rows_of["T"] = self._tree(hidden[:, tail], words[tail], scale)
            back[:, tail] += states
        d_out = np.zeros((n, valid.size), dtype=self.flat.dtype)
        d_out[:, use] = back
        d_out = d_out.reshape(out.shape)
        # all that does not wait for the step behind it, at once
        z, r = gates[:n], gates[n:]
        d_fresh = (1 - z) * (1 - fresh * fresh)
        slope = gates * (1 - gates)
        slope[:n] *= past - fresh
        slope[n:] *= drive
        d_a = np.empty((3 * n, *inputs.shape), dtype=self.flat.dtype)
        d_u = np.empty_like(d_a)
        carry = np.zeros_like(h)
        for t in range(len(inputs) - 1, -1, -1):
            carry += d_out[:, t]
            d_new = d_a[2 * n :, t]
            np.multiply(carry, d_fresh[:, t], out=d_new)
            np.multiply(carry, slope[:n, t], out=d_a[:n, t])
            np.multiply(d_new, slope[n:, t], out=d_a[n : 2 * n, t])
            d_u[: 2 * n, t] = d_a[: 2 * n, t]
            np.multiply(d_new, r[:, t], out=d_u[2 * n :, t])
            carry *= z[:, t]
            carry += p["U"] @ d_u[:, t]
            carry *= keep[t]
        flat_a = d_a.reshape(3 * n, -1)
        g["U"] += past.reshape(n, -1) @ d_u.reshape(3 * n, -1).T
        g["b"] += flat_a.sum(axis=1)
        # gradients of the inputs' rows first: the weights behind them see each row once
        order = np.argsort(inputs, axis=None, kind="stable")
        sorted_ = inputs.ravel()[order]
        starts = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
        rows, sums = sorted_[starts], np.add.reduceat(np.take(flat_a, order, axis=1), starts, axis=1).T
        g["W"] += self._embed(rows).T @ sums
        sums = sums @ p["W"].T
        np.add.at(g["G"], self.shape.group(rows), sums)
        rows_of["E"] = rows, sums
        return grad, rows_of, last

    def update(self, grad: np.ndarray, share: float, rate: float = 0.01) -> None:
        """One step of Adam, shorter for a window that is only partly full; the gradient is clipped to length 1.

        It is for all but the parts E and T, see `update_rows`.
        """
        length = float(np.sqrt((grad * grad).sum()))
        if length > 1:
            grad = grad / length
        self.steps += 1
        self.first += 0.1 * (grad - self.first)
        self.second += 0.01 * (grad * grad - self.second)
        rate = self.rate * rate * min(1.0, 2 * share) / (1 + self.steps / 1000) * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        self.flat[: self.shape.dense] -= np.float32(rate) * self.first / (np.sqrt(self.second) + 1e-7)

    def update_rows(self, rows_of: dict, tokens: int, rate: float = 0.1) -> None:
        """One step of Adagrad for the rows that a window of so many tokens touched, a rate for each row.

        Rows begin as if they had seen gradients of length 1, so a word seen once moves little.
        """
        for name, (rows, grad) in rows_of.items():
            grad = grad * np.float32(tokens)
            self.seen[name][rows] += np.einsum("ij,ij->i", grad, grad)
            grad *= (np.float32(self.rate * rate) / np.sqrt(self.seen[name][rows]))[:, None]
            self.p[name][rows] -= grad

    def learn(self, lanes: Lanes, inputs, keep, classes, words) -> None:
        """One pass over flat token arrays in the order of the lanes."""
        h = np.zeros((STATE, len(lanes.length)), dtype=np.float32)
        full = len(lanes.length) * WINDOW
        with np.errstate(over="ignore"):
            for places, valid in lanes.windows():
                h = h[:, : places.shape[1]]
                grad, rows_of, h = self._gradient(inputs[places], keep[places], valid, classes[places], words[places], h)
                tokens = int(valid.sum())
                self.update(grad, tokens / full)
                self.update_rows(rows_of, tokens)

    def score(self, lanes: Lanes, inputs, keep, classes, words) -> np.ndarray:
        """Natural log probability of every token of the flat arrays."""
        found = np.zeros(len(inputs), dtype=np.float64)
        h = np.zeros((STATE, len(lanes.length)), dtype=np.float32)
        with np.errstate(over="ignore"):
            for places, valid in lanes.windows():
                h = h[:, : places.shape[1]]
                out, h, _ = self.states(inputs[places], keep[places], h)
                at, use = places[valid], np.flatnonzero(valid.ravel())
                found[at] = self.log_probs(out.reshape(STATE, -1)[:, use], classes[at], words[at])
        return found
