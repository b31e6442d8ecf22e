"""Bidirectional LSTM over characters with a CRF on top: training and decoding in numpy, reading in onnxruntime.

Gates are lines cut at 0 and MOST, in training as in reading, which cost next to
nothing. As no gate opens wholly, what a cell holds fades by a tenth with each
character, so that texts much longer than those of training do not fill it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fleetwatt.llm.onnx_graph import FLOAT, INT32, graph, model, node, value

try:
    import onnxruntime
except ImportError:  # numpy reads the same, more slowly
    onnxruntime = None

LINE = 0.2  # slope of a gate
MOST = 0.9


def gate(x: np.ndarray) -> np.ndarray:
    return np.clip(LINE * x + 0.5, 0, MOST).astype(x.dtype, copy=False)


def gate_slope(y: np.ndarray) -> np.ndarray:
    """The derivative of ``gate`` where it gives ``y``."""
    return LINE * ((y > 0) & (y < np.asarray(MOST, y.dtype))).astype(y.dtype)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Weights by name: embedding, one LSTM per direction, output layer, CRF transitions and ends."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(symbols: int, tags: int, embedding: int = 10, hidden: int = 16, seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)

        def draw(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        weights = {"embed": draw(symbols, embedding) * np.sqrt(symbols).astype(np.float32) * 0.5}
        for way in "fb":
            weights["x" + way] = draw(embedding, 4 * hidden)
            weights["h" + way] = draw(hidden, 4 * hidden)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1  # remember at first
            weights["b" + way] = bias
        weights["out"], weights["out0"] = draw(2 * hidden, tags), np.zeros(tags, np.float32)
        weights["move"] = np.zeros((tags, tags), np.float32)
        weights["first"] = np.zeros(tags, np.float32)
        return Tagger(weights)

    def run(self, x: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, tuple]:
        """Hidden states (batch x time x hidden) of one direction, and what training needs."""
        w = self.weights
        hidden = w["h" + way].shape[0]
        table = w["embed"] @ w["x" + way] + w["b" + way]
        batch, time = x.shape
        h, c = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
        states = np.empty((time, batch, hidden), np.float32)
        kept = []
        for t in range(time) if way == "f" else range(time - 1, -1, -1):
            z = table[x[:, t]] + h @ w["h" + way]
            gates = gate(z[:, : 3 * hidden])
            i, f, o = gates[:, :hidden], gates[:, hidden : 2 * hidden], gates[:, 2 * hidden :]
            g = np.tanh(z[:, 3 * hidden :])
            before, past = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[t] = h
            if keep:
                kept.append((t, i, f, o, g, tc, before, past))
        return states, tuple(kept)

    def reader(self) -> bytes:
        """Both LSTMs and the output layer as an ONNX model.

        ``symbols`` (time x 2 x batch) come in reading order, those of the second
        direction as many higher as there are; ``shares`` (time x 2 x batch x tags) are
        what each direction adds to the scores.
        """
        w = self.weights
        hidden = w["hf"].shape[0]
        table = np.concatenate([w["embed"] @ w["x" + way] + w["b" + way] for way in "fb"])
        turn = np.stack([w["h" + way] for way in "fb"])
        constants = {"out": w["out"].reshape(2, hidden, -1), "least": np.zeros(()), "most": np.array(MOST)}
        nodes = []
        # "s" are the gates i, f and o, "g" is what is taken in. The line of the gates is in their weights.
        for name, part, slope, middle in (("s", slice(0, 3 * hidden), LINE, 0.5), ("g", slice(3 * hidden, None), 1, 0)):
            constants |= {"table_" + name: slope * table[:, part] + middle, "turn_" + name: slope * turn[:, :, part]}
            nodes += [node("Gather", f"table_{name} x", "x_" + name), node("MatMul", f"h turn_{name}", "h_" + name), node("Add", f"x_{name} h_{name}", "z_" + name)]
        nodes += [
            node("Clip", "z_s least most", "gates"),
            node("Split", "gates", "i f o", axis=2),
            node("Tanh", "z_g", "g"),
            node("Mul", "i g", "taken"),
            node("Mul", "f c", "held"),
            node("Add", "taken held", "c_next"),
            node("Tanh", "c_next", "told"),
            node("Mul", "o told", "h_next"),
            node("MatMul", "h_next out", "share"),
        ]
        rows, tags = (2, "batch", hidden), w["out"].shape[1]
        step = graph(
            nodes,
            [value("h", FLOAT, *rows), value("c", FLOAT, *rows), value("x", INT32, 2, "batch")],
            [value("h_next", FLOAT, *rows), value("c_next", FLOAT, *rows), value("share", FLOAT, 2, "batch", tags)],
        )
        whole = [node("Scan", "start start symbols", "h_last c_last shares", body=step, num_scan_inputs=1)]
        inputs = [value("start", FLOAT, *rows), value("symbols", INT32, "time", 2, "batch")]
        return model(graph(whole, inputs, [value("shares", FLOAT, "time", 2, "batch", tags)], constants))

    def __getstate__(self) -> dict:
        return {"weights": self.weights}  # a session stays in its process

    def shares(self, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """Each direction's share of the scores (time x 2 x batch x tags) of symbols (time x batch) in its reading order."""
        w = self.weights
        hidden = w["hf"].shape[0]
        if onnxruntime is None:
            return np.stack([self.run(ahead.T, "f", False)[0] @ w["out"][:hidden], self.run(behind[::-1].T, "b", False)[0][::-1] @ w["out"][hidden:]], 1)
        # Made once for these weights: training replaces them.
        if getattr(self, "session_of", None) is not w["out"]:
            options = onnxruntime.SessionOptions()
            options.intra_op_num_threads = options.inter_op_num_threads = 1  # a task has one core
            self.session = onnxruntime.InferenceSession(self.reader(), options, providers=["CPUExecutionProvider"])
            self.session_of = w["out"]
        symbols = np.empty((len(ahead), 2, ahead.shape[1]), np.int32)
        symbols[:, 0] = ahead
        np.add(behind, len(w["embed"]), symbols[:, 1], dtype=np.int32)
        return self.session.run(None, {"start": np.zeros((2, ahead.shape[1], hidden), np.float32), "symbols": symbols})[0]

    def emissions(self, x: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """Scores of the tags: batch x time x tags.

        ``lengths`` tell where rows end: each is read from both of its own ends, so
        that the others do not matter, and what lies beyond is of no account.
        """
        batch, time = x.shape
        places, rows = np.arange(time), np.arange(batch)[:, None]
        lengths = np.full(batch, time) if lengths is None else lengths
        turned = np.maximum(lengths[:, None] - 1 - places, 0)
        shares = self.shares(x.T, np.take_along_axis(x, turned, 1).T)
        tags = shares.shape[3]
        shares = shares.reshape(-1, tags)
        # In long rows, as numpy is slow on short ones.
        scores = np.take(shares, 2 * batch * places + rows, 0).reshape(batch, -1)
        scores += np.take(shares, 2 * batch * turned + batch + rows, 0).reshape(batch, -1)
        scores += np.tile(self.weights["out0"], time)
        return scores.reshape(batch, time, tags)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of the tag sequences ``y`` and its gradient."""
        w = self.weights
        batch, time = x.shape
        tags = len(w["first"])
        states, kept = {}, {}
        for way in "fb":
            states[way], kept[way] = self.run(x, way, True)
        both = np.concatenate([states["f"], states["b"]], 2)
        scores = both @ w["out"] + w["out0"]  # time x batch x tags
        move, rows = w["move"], np.arange(batch)
        ahead = np.empty_like(scores)
        ahead[0] = w["first"] + scores[0]
        for t in range(1, time):
            ahead[t] = scores[t] + log_sum(ahead[t - 1][:, :, None] + move, 1)
        behind = np.zeros_like(scores)
        for t in range(time - 2, -1, -1):
            behind[t] = log_sum(move + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        total = log_sum(ahead[-1], 1)
        right = w["first"][y[:, 0]] + scores[0, rows, y[:, 0]]
        for t in range(1, time):
            right = right + move[y[:, t - 1], y[:, t]] + scores[t, rows, y[:, t]]
        marginal = np.exp(ahead + behind - total[None, :, None])
        d_scores = marginal.copy()
        for t in range(time):
            d_scores[t, rows, y[:, t]] -= 1
        d_scores /= batch
        grads = {name: np.zeros_like(value) for name, value in w.items()}
        grads["first"] = d_scores[0].sum(0)
        for t in range(1, time):
            pair = np.exp(ahead[t - 1][:, :, None] + move + (scores[t] + behind[t])[:, None, :] - total[:, None, None])
            grads["move"] += pair.sum(0) / batch
            np.add.at(grads["move"], (y[:, t - 1], y[:, t]), -1 / batch)
        flat = d_scores.reshape(-1, tags)
        grads["out"] = both.reshape(-1, both.shape[2]).T @ flat
        grads["out0"] = flat.sum(0)
        d_both = d_scores @ w["out"].T
        hidden = w["hf"].shape[0]
        for n, way in enumerate("fb"):
            d_states = d_both[:, :, n * hidden : (n + 1) * hidden]
            dh, dc = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
            d_table = np.zeros((len(w["embed"]), 4 * hidden), np.float32)
            for t, i, f, o, g, tc, before, past in reversed(kept[way]):
                dh = dh + d_states[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * gate_slope(i), dc * past * gate_slope(f), dh * tc * gate_slope(o), dc * i * (1 - g * g)], 1)
                grads["h" + way] += before.T @ dz
                np.add.at(d_table, x[:, t], dz)
                dh, dc = dz @ w["h" + way].T, dc * f
            grads["b" + way] = d_table.sum(0)
            grads["x" + way] = w["embed"].T @ d_table
            grads["embed"] += d_table @ w["x" + way].T
        return float((total - right).mean()), grads

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 48, rate: float = 0.02, seed: int = 4) -> list[float]:
        """Adam with a rate that falls to a tenth; the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        mean = {n: np.zeros_like(v) for n, v in self.weights.items()}
        square = {n: np.zeros_like(v) for n, v in self.weights.items()}
        step, losses = 0, []
        steps = epochs * max(1, -(-len(x) // batch))
        for _ in range(epochs):
            order = rng.permutation(len(x))
            spent = []
            for at in range(0, len(x), batch):
                own = order[at : at + batch]
                loss, grads = self.gradients(x[own], y[own])
                spent.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                now = rate * (1 - 0.9 * step / steps)
                for n, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    mean[n] = 0.9 * mean[n] + 0.1 * g
                    square[n] = 0.99 * square[n] + 0.01 * g * g
                    fixed = mean[n] / (1 - 0.9**step) / (np.sqrt(square[n] / (1 - 0.99**step)) + 1e-7)
                    self.weights[n] = (self.weights[n] - now * fixed).astype(np.float32)
            losses.append(float(np.mean(spent)))
        return losses

    def in_doubt(self, scores: np.ndarray) -> np.ndarray:
        """Where the best tags of ``scores`` (time x tags) may be other than 0; everywhere else they are 0.

        A run of other tags gains, against a run of 0 in its place, at most the lead
        of the best other tag at each place, the most that a move within the run
        gains, and what entering and leaving it costs at least. Where no run over a
        place can gain, the place has tag 0. The largest sum over a place is a
        difference of running extremes.
        """
        move, first = self.weights["move"].astype(float), self.weights["first"].astype(float)
        within = move[1:, 1:].max() - move[0, 0]
        enter, leave = move[0, 1:].max() - move[0, 0], move[1:, 0].max() - move[0, 0]
        rows = np.ascontiguousarray(scores.T)  # a maximum over long rows is faster
        gain = (rows[1:].max(0) - rows[0]).astype(float) + within
        sums = np.concatenate([[0], np.cumsum(gain)])
        # At the ends of the text a run is not entered or left, but begins or ends there.
        opened = sums[:-1] - enter
        opened[0] = sums[0] - (first[1:].max() - first[0])
        closed = sums[1:] + leave
        closed[-1] = sums[-1]
        most = np.maximum.accumulate(closed[::-1])[::-1] - np.minimum.accumulate(opened)
        return most - within > -1e-3 * (1 + np.abs(gain).max())

    def best(self, scores: np.ndarray, lengths: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None) -> np.ndarray:
        """Best tag sequences (batch x time) of emissions; what lies beyond a length is of no account.

        ``before`` and ``after`` (batch x tags) are the scores of the first and last
        tag by what lies around the sequence; without them it is a whole text.
        """
        batch, time, tags = scores.shape
        move = self.weights["move"]
        # Tags lead, so that each step works on long rows; which tag came before is asked on the way back.
        scores = np.ascontiguousarray(scores.transpose(1, 2, 0))
        now = (self.weights["first"][:, None] if before is None else before.T) + scores[0]
        past = np.empty((time, tags, batch), now.dtype)
        past[0] = now
        for t in range(1, time):
            np.add((past[t - 1][:, None] + move[:, :, None]).max(0), scores[t], past[t])
        last = past[lengths - 1, :, np.arange(batch)]
        out = np.zeros((batch, time), np.int8)
        tag = (last if after is None else last + after).argmax(1)
        for t in range(time - 1, -1, -1):
            live = t < lengths
            out[:, t] = np.where(live, tag, 0)
            if t:
                tag = np.where(live, (past[t - 1] + move[:, tag]).argmax(0), tag)
        return out

    def decoded(self, texts: list[np.ndarray], batch: int = 512) -> list[np.ndarray]:
        """Best tags of each of ``texts`` (time x tags): only parts in doubt are searched, with tag 0 around them."""
        out = [np.zeros(len(s), np.int8) for s in texts]
        parts: list[tuple[int, int, int]] = []
        for n, scores in enumerate(texts):
            if len(scores):
                edges = np.flatnonzero(np.diff(np.concatenate([[False], self.in_doubt(scores), [False]]).astype(np.int8)))
                parts += [(n, a, b) for a, b in edges.reshape(-1, 2).tolist()]
        parts.sort(key=lambda p: p[2] - p[1])
        move, first = self.weights["move"], self.weights["first"]
        nothing = np.zeros_like(first)
        sizes = np.array([b - a for _, a, b in parts])
        at = 0
        while at < len(parts):
            # Parts of about one length, so that a long one does not pad many short ones.
            stop = min(at + batch, int(np.searchsorted(sizes, max(16, 1.5 * sizes[at]), "right")))
            some, lengths = parts[at:stop], sizes[at:stop]
            at = stop
            padded = np.zeros((len(some), int(lengths.max()), len(first)), np.float32)
            for row, (n, a, b) in enumerate(some):
                padded[row, : b - a] = texts[n][a:b]
            before = np.stack([move[0] if a else first for _, a, _ in some])
            after = np.stack([move[:, 0] if b < len(texts[n]) else nothing for n, _, b in some])
            found = self.best(padded, lengths, before, after)
            for row, (n, a, b) in enumerate(some):
                out[n][a:b] = found[row, : b - a]
        return out
