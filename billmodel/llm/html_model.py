"""A bidirectional LSTM over a page's blocks, in numpy: one score a block."""

from __future__ import annotations

from zlib import crc32

import numpy as np

from billmodel.llm.html_blocks import Block

#: Buckets of hashed path words and text words, and the lengths of their vectors.
PATH_BUCKETS, PATH_SIZE = 2048, 24
WORD_BUCKETS, WORD_SIZE = 4096, 8
#: Plain numbers of a block.
NUMBERS = 8
INPUTS = PATH_SIZE + WORD_SIZE + NUMBERS
#: Blocks (rows times their longest) that are scored at once; a longer page goes alone.
CELLS = 1 << 13
#: Words of a block that are looked up at once, and paths that a worker keeps.
WORDS, PATHS = 1 << 16, 20_000
_MARKS = frozenset(".,;:!?")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def path_ids(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
    """Buckets of a path's words; the innermost elements' count once more by
    their distance from the leaf."""
    out = [crc32(w.encode()) % PATH_BUCKETS for words in path for w in words]
    out += [crc32(f"{d}{words[0]}".encode()) % PATH_BUCKETS for d, words in enumerate(path[:-4:-1])]
    return np.array(out or [0], np.int64)


def word_ids(text: str) -> list[np.ndarray]:
    """Buckets of all words of a text, a slice at a time."""
    out, at, low = [], 0, text.lower()
    while at < len(low):
        end = len(low) if at + 8 * WORDS >= len(low) else low.find(" ", at + 8 * WORDS)
        end = len(low) if end < 0 else end
        words = low[at:end].encode("utf-8", "surrogatepass").split()
        if words:
            out.append(np.fromiter(map(crc32, words), np.int64, len(words)) % WORD_BUCKETS)
        at = end
    return out or [np.zeros(1, np.int64)]


def numbers(blocks: list[Block]) -> np.ndarray:
    """Length, links, marks, digits, capitals, depth and place of every block."""
    out = np.empty((len(blocks), NUMBERS), np.float32)
    last = max(1, len(blocks) - 1)
    for n, b in enumerate(blocks):
        size = len(b.text)
        head = b.text[-1:]
        spaces = b.text.count(" ")
        out[n] = (np.log1p(size) / 8, b.linked, 10 * sum(map(b.text.count, _MARKS)) / size, head in ".!?", np.log1p(spaces) / 6,
                  min(b.depth, 32) / 16, n / last, min(n, 50) / 50)
    return out


class Labeller:
    """Parameters: ``paths`` and ``words`` (bucket, vector), ``inputs`` (direction,
    input, 4 gates), ``recur`` (direction, state, 4 gates), ``bias`` (direction,
    4 gates), ``out`` (2 states), ``base`` (1)."""

    def __init__(self, states: int = 24, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        self.states = states
        self.paths, self.words = draw(0.3, PATH_BUCKETS, PATH_SIZE), draw(0.1, WORD_BUCKETS, WORD_SIZE)
        self.inputs, self.recur = draw(0.2, 2, INPUTS, 4 * states), draw(0.2, 2, states, 4 * states)
        self.bias = np.zeros((2, 4 * states), np.float32)
        self.bias[:, states : 2 * states] = 1.0  # remember at first
        self.out, self.base = draw(0.2, 2 * states), np.zeros(1, np.float32)
        self._kept: dict[tuple, np.ndarray] = {}

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.paths, self.words, self.inputs, self.recur, self.bias, self.out, self.base]

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_kept": {}}

    # --- forward -----------------------------------------------------------------

    def features(self, blocks: list[Block]) -> np.ndarray:
        """Inputs (block, number) of a page."""
        out = np.empty((len(blocks), INPUTS), np.float32)
        if len(self._kept) > PATHS:
            self._kept.clear()
        for n, b in enumerate(blocks):
            vector = self._kept.get(b.path)
            if vector is None:
                vector = self._kept[b.path] = self.paths[path_ids(b.path)].mean(axis=0)
            out[n, :PATH_SIZE] = vector
            parts = word_ids(b.text)
            if len(parts) == 1:
                out[n, PATH_SIZE : PATH_SIZE + WORD_SIZE] = self.words[parts[0]].mean(axis=0)
            else:
                counts = sum(np.bincount(p, minlength=WORD_BUCKETS) for p in parts)
                out[n, PATH_SIZE : PATH_SIZE + WORD_SIZE] = counts @ self.words / counts.sum()
        out[:, PATH_SIZE + WORD_SIZE :] = numbers(blocks)
        return out

    def _run(self, x: np.ndarray, lengths: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states (row, position, 2 * states) of padded rows; a row's
        states stay at zero beyond its length, in either direction."""
        n, length, _ = x.shape
        s = self.states
        gates_in = np.stack([x @ self.inputs[0] + self.bias[0], x @ self.inputs[1] + self.bias[1]])
        h, c = np.zeros((2, n, s), np.float32), np.zeros((2, n, s), np.float32)
        out = np.zeros((n, length, 2 * s), np.float32)
        for t in range(length):
            back = length - 1 - t
            z = np.matmul(h, self.recur)
            z[0] += gates_in[0][:, t]
            z[1] += gates_in[1][:, back]
            g3 = _sigmoid(z[:, :, : 3 * s])
            i, f, o, g = g3[:, :, :s], g3[:, :, s : 2 * s], g3[:, :, 2 * s :], np.tanh(z[:, :, 3 * s :])
            on = np.stack([t < lengths, back < lengths]).astype(np.float32)[:, :, None]
            c2 = (f * c + i * g) * on
            squashed = np.tanh(c2)
            h2 = o * squashed * on
            if keep is not None:
                keep.append([h, c, i, f, o, g, squashed, on])
            h, c = h2, c2
            out[:, t, :s] = h[0]
            out[:, back, s:] = h[1]
        return out

    def scores(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """A score for each block of each page; above zero is main text."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        first = 0
        while first < len(order):
            end = first + 1
            while end < len(order) and (end + 1 - first) * len(pages[order[end]]) <= CELLS:
                end += 1
            some, first = order[first:end], end
            lengths = np.array([len(pages[i]) for i in some])
            x = np.zeros((len(some), int(lengths[-1]), INPUTS), np.float32)
            for r, i in enumerate(some):
                x[r, : lengths[r]] = self.features(pages[i])
            score = self._run(x, lengths) @ self.out + self.base
            for r, i in enumerate(some):
                out[i] = score[r, : lengths[r]]
        return out

    # --- training ----------------------------------------------------------------

    def step(self, pages: list[list[Block]], labels: list[np.ndarray]) -> tuple[float, list[np.ndarray]]:
        """Mean log loss of pages' blocks and its gradients."""
        n, s = len(pages), self.states
        lengths = np.array([len(p) for p in pages])
        length, total = int(lengths.max()), float(lengths.sum())
        x, y, keep = np.zeros((n, length, INPUTS), np.float32), np.zeros((n, length), np.float32), []
        mask = np.arange(length) < lengths[:, None]
        self._kept.clear()
        for r, (p, l) in enumerate(zip(pages, labels)):
            x[r, : len(p)], y[r, : len(p)] = self.features(p), l
        hidden = self._run(x, lengths, keep)
        score = hidden @ self.out + self.base
        loss = float((np.logaddexp(0, score) - y * score)[mask].sum() / total)
        d_score = np.where(mask, _sigmoid(score) - y, 0).astype(np.float32) / total
        d_out, d_base = np.einsum("nts,nt->s", hidden, d_score), d_score.sum(keepdims=True).reshape(1)
        d_hidden = d_score[:, :, None] * self.out
        d_recur, d_gates = np.zeros_like(self.recur), np.zeros((2, n, length, 4 * s), np.float32)
        dh, dc = np.zeros((2, n, s), np.float32), np.zeros((2, n, s), np.float32)
        turned = self.recur.transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            back = length - 1 - t
            h0, c0, i, f, o, g, squashed, on = keep[t]
            dh[0] += d_hidden[:, t, :s]
            dh[1] += d_hidden[:, back, s:]
            dh *= on
            dc = (dc + dh * o * (1 - squashed**2)) * on
            dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=2)
            d_recur += np.matmul(h0.transpose(0, 2, 1), dz)
            d_gates[0][:, t], d_gates[1][:, back] = dz[0], dz[1]
            dh, dc = np.matmul(dz, turned), dc * f
        flat = x.reshape(-1, INPUTS)
        d_inputs = np.stack([flat.T @ d.reshape(-1, 4 * s) for d in d_gates])
        d_bias = d_gates.sum(axis=(1, 2))
        dx = d_gates[0] @ self.inputs[0].T + d_gates[1] @ self.inputs[1].T
        d_paths, d_words = np.zeros_like(self.paths), np.zeros_like(self.words)
        for r, p in enumerate(pages):
            for t, b in enumerate(p):
                ids = path_ids(b.path)
                np.add.at(d_paths, ids, dx[r, t, :PATH_SIZE] / len(ids))
                for ids in word_ids(b.text)[:1]:
                    np.add.at(d_words, ids, dx[r, t, PATH_SIZE : PATH_SIZE + WORD_SIZE] / len(ids))
        return loss, [d_paths, d_words, d_inputs, d_recur, d_bias, d_out, d_base]

    def fit(self, pages: list[list[Block]], labels: list[np.ndarray], rounds: int = 6, batch: int = 24, rate: float = 0.01, seed: int = 3) -> list[float]:
        """Adam over shuffled pages, those of like length together; the losses."""
        rng, losses, k = np.random.default_rng(seed), [], 0
        first = [np.zeros_like(p) for p in self.parameters]
        second = [np.zeros_like(p) for p in self.parameters]
        by_length = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        groups = [by_length[i : i + batch] for i in range(0, len(by_length), batch)]
        steps = rounds * len(groups)
        for _ in range(rounds):
            for at in rng.permutation(len(groups)):
                k += 1
                loss, grads = self.step([pages[i] for i in groups[at]], [labels[i] for i in groups[at]])
                losses.append(loss)
                norm = max(1.0, float(np.sqrt(sum((g**2).sum() for g in grads))) / 5)
                pace = rate * min(1.0, 2 * (1 - k / (steps + 1)))
                for p, g, m, v in zip(self.parameters, grads, first, second):
                    g = g / norm
                    m += 0.1 * (g - m)
                    v += 0.01 * (g**2 - v)
                    p -= (pace * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
        self._kept.clear()
        return losses
