"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tags: outside, then begin and inside of every kind.
TAGS = 1 + 2 * len(KINDS)
#: Characters that the model tells apart: letters a-z (either case), digits as
#: one, the punctuation below, white space, other letters, anything else.
PUNCTUATION = "@.+-_%()/:,;#*'\""
CLASSES = 26 + 1 + len(PUNCTUATION) + 3
NEVER = -1e4
#: Positions (rows times their longest) that are decoded at once; a longer stretch goes alone.
CELLS = 1 << 20


def _class_table() -> np.ndarray:
    out = np.full(0x250, CLASSES - 1, np.uint8)
    for c in range(0x250):
        ch = chr(c)
        if ch in PUNCTUATION:
            out[c] = 27 + PUNCTUATION.index(ch)
        elif ch.isspace():
            out[c] = CLASSES - 3
        elif "0" <= ch <= "9":
            out[c] = 26
        elif ch.isascii() and ch.isalpha():
            out[c] = ord(ch.lower()) - 97
        elif ch.isalpha():
            out[c] = CLASSES - 2
    return out


_CLASS = _class_table()


def classes(text: str) -> np.ndarray:
    """Class of every code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CLASS[np.minimum(points, 0x24F)]


def allowed() -> np.ndarray:
    """Transition mask: inside a kind only follows its begin or inside."""
    mask = np.zeros((TAGS, TAGS), np.float32)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        mask[:, inside] = NEVER
        mask[[inside - 1, inside], inside] = 0
    return mask


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(x - most).sum(axis=axis))


class Tagger:
    """Parameters: ``inputs`` (direction, class, 4 gates), ``recur`` (direction,
    state, 4 gates), ``out`` (2 states, tag), ``bias`` (tag), ``moves`` (tag, tag)."""

    def __init__(self, states: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
        self.states = states
        self.inputs = draw(2, CLASSES + 1, 4 * states)  # the last class pads
        self.inputs[:, :, states : 2 * states] += 1.0  # remember at first
        self.recur = draw(2, states, 4 * states)
        self.out = draw(2 * states, TAGS)
        self.bias = np.zeros(TAGS, np.float32)
        self.moves = np.zeros((TAGS, TAGS), np.float32)

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.recur, self.out, self.bias, self.moves]

    # --- forward -----------------------------------------------------------------

    def _run(self, chars: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (row, position, 2 * states) for rows of classes."""
        n, length = chars.shape
        s = self.states
        both = np.stack([chars, chars[:, ::-1]])
        h, c = np.zeros((2, n, s), np.float32), np.zeros((2, n, s), np.float32)
        out = np.empty((n, length, 2 * s), np.float32)
        for t in range(length):
            z = np.matmul(h, self.recur)
            z[0] += self.inputs[0][both[0, :, t]]
            z[1] += self.inputs[1][both[1, :, t]]
            gates = _sigmoid(z[:, :, : 3 * s])
            i, f, o, g = gates[:, :, :s], gates[:, :, s : 2 * s], gates[:, :, 2 * s :], np.tanh(z[:, :, 3 * s :])
            if keep is not None:
                keep.append([h, c, i, f, o, g])
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            if keep is not None:
                keep[-1].append(squashed)
            out[:, t, :s] = h[0]
            out[:, length - 1 - t, s:] = h[1]
        return out

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        """Tag scores (row, position, tag)."""
        return self._run(chars) @ self.out + self.bias

    # --- training ----------------------------------------------------------------

    def step(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log likelihood of rows and its gradients."""
        n, length = chars.shape
        s, keep = self.states, []
        hidden = self._run(chars, keep)
        scores = hidden @ self.out + self.bias
        moves = self.moves + allowed()
        alpha = np.empty_like(scores)
        alpha[:, 0] = scores[:, 0]
        for t in range(1, length):
            alpha[:, t] = scores[:, t] + _log_sum(alpha[:, t - 1, :, None] + moves, 1)
        beta = np.zeros_like(scores)
        for t in range(length - 2, -1, -1):
            beta[:, t] = _log_sum(moves + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = _log_sum(alpha[:, -1], 1)
        row, at = np.arange(n)[:, None], np.arange(length)[None, :]
        gold = scores[row, at, tags].sum() + moves[tags[:, :-1], tags[:, 1:]].sum()
        loss = float(total.sum() - gold) / n
        d_scores = np.exp(alpha + beta - total[:, None, None])
        d_scores[row, at, tags] -= 1
        d_scores /= n
        d_moves = np.zeros_like(moves)
        for t in range(1, length):
            d_moves += np.exp(alpha[:, t - 1, :, None] + moves + (scores[:, t] + beta[:, t])[:, None, :] - total[:, None, None]).sum(axis=0)
        np.add.at(d_moves, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
        d_moves /= n
        d_out = hidden.reshape(-1, 2 * s).T @ d_scores.reshape(-1, TAGS)
        d_bias = d_scores.sum(axis=(0, 1))
        d_hidden = d_scores @ self.out.T
        d_inputs, d_recur = np.zeros_like(self.inputs), np.zeros_like(self.recur)
        dh, dc = np.zeros((2, n, s), np.float32), np.zeros((2, n, s), np.float32)
        turned = self.recur.transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            h0, c0, i, f, o, g, squashed = keep[t]
            dh[0] += d_hidden[:, t, :s]
            dh[1] += d_hidden[:, length - 1 - t, s:]
            dc = dc + dh * o * (1 - squashed**2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=2)
            d_recur += np.matmul(h0.transpose(0, 2, 1), dz)
            np.add.at(d_inputs[0], chars[:, t], dz[0])
            np.add.at(d_inputs[1], chars[:, length - 1 - t], dz[1])
            dh, dc = np.matmul(dz, turned), dc * f
        return loss, [d_inputs, d_recur, d_out, d_bias, d_moves]

    def fit(self, chars: np.ndarray, tags: np.ndarray, steps: int = 240, batch: int = 64, rate: float = 0.02, seed: int = 3) -> list[float]:
        """Adam over shuffled rows; the losses."""
        rng, losses = np.random.default_rng(seed), []
        first = [np.zeros_like(p) for p in self.parameters]
        second = [np.zeros_like(p) for p in self.parameters]
        order = np.zeros(0, np.int64)
        for k in range(1, steps + 1):
            if len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(chars))])
            rows, order = order[:batch], order[batch:]
            loss, grads = self.step(chars[rows], tags[rows])
            losses.append(loss)
            norm = max(1.0, float(np.sqrt(sum((g**2).sum() for g in grads))) / 5)
            pace = rate * min(1.0, 2 * (1 - k / (steps + 1)))
            for p, g, m, v in zip(self.parameters, grads, first, second):
                g = g / norm
                m += 0.1 * (g - m)
                v += 0.01 * (g**2 - v)
                p -= (pace * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
        return losses

    # --- decoding ----------------------------------------------------------------

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Best tag sequences of stretches (position, tag), side by side as
        far as their positions fit ``CELLS``; all of a stretch in one pass."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(scores)
        by_length = sorted((i for i in range(len(scores)) if len(scores[i])), key=lambda i: len(scores[i]))
        moves = self.moves + allowed()
        first = 0
        while first < len(by_length):
            end = first + 1
            while end < len(by_length) and (end + 1 - first) * len(scores[by_length[end]]) <= CELLS:
                end += 1
            some, first = by_length[first:end], end
            lengths = np.array([len(scores[i]) for i in some])
            length = int(lengths[-1])
            if len(some) == 1:
                grid = scores[some[0]][None]
            else:
                grid = np.zeros((len(some), length, TAGS), np.float32)
                for r, i in enumerate(some):
                    grid[r, : len(scores[i])] = scores[i]
            best, back = grid[:, 0] + allowed()[0], np.zeros((length, len(some), TAGS), np.int8)
            # rows before this one have ended: they stay as they are, whatever is beside them
            ended = np.searchsorted(lengths, np.arange(length), "right").tolist()
            for t in range(1, length):
                on = ended[t]
                paths = best[on:, :, None] + moves
                back[t, on:] = paths.argmax(axis=1)
                best[on:] = paths.max(axis=1) + grid[on:, t]
            tag = best.argmax(axis=1)
            tags, row = np.empty((len(some), length), np.int8), np.arange(len(some))
            for t in range(length - 1, -1, -1):
                on = ended[t]
                tags[:, t] = tag
                tag[on:] = back[t][row[on:], tag[on:]]
            for r, i in enumerate(some):
                out[i] = tags[r, : len(scores[i])]
        return out


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of a tag sequence."""
    out = []
    kind, start = None, 0
    for at, tag in enumerate([*tags.tolist(), 0]):
        if kind is not None and tag != 2 + 2 * kind:
            out.append((kind, start, at))
            kind = None
        if tag and tag % 2:
            kind, start = (tag - 1) // 2, at
    return out
