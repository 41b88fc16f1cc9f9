"""Byte-level BPE encoding and decoding with a published rank file.

A text is cut by the vocabulary's pattern and every match encoded by itself. A
match that is a token as a whole is that token. Else its bytes are the leaves of
a segment tree: leaf ``i`` holds the rank of the pair that starts at byte ``i``
and the root the least rank, the leftmost of equals. A merge takes the root's
pair, joins the two tokens and updates three leaves (the pair itself, the one
before and the swallowed one), a logarithmic number of nodes each, until no
pair is left. Trees of short matches are merged side by side in arrays, one
step for all of them at a time; long matches have a tree of their own.

Matches repeat, so a worker keeps what it has worked out of words it has met: their
ids as decimal text, once they were decoded again to the word itself. It keeps
two generations of a bounded number; a word that is met moves to the younger, and
when that is full the older is dropped. A text whose words all decode to themselves
decodes to itself; any other is decoded id by id. Texts are encoded whole, in blocks, inside the tasks of the scan: nothing is
shuffled. A null text is empty and has no ids; a null id stays null; repeated
rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmodel.llm.common import arrow_rows, ship_package

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<long>"
#: Words kept by a worker in each generation, and the longest that it keeps.
KEPT_WORDS, KEPT_LENGTH = 150_000, 48
#: Characters of text encoded at once.
BLOCK = 1 << 19
#: Matches of more bytes get a tree of their own.
SIDE_BY_SIDE = 256
NONE = np.iinfo(np.int64).max


class Vocabulary:
    """Token ranks of a tiktoken file, and which two tokens make which."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.shift = max(self.tokens).bit_length()
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a << self.shift | b] = rank
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of what the pairs make; NONE where they make no token."""
        key = left << self.shift | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.values[at], NONE)


def merge_together(pieces: list[bytes], width: int, vocabulary: Vocabulary) -> list[list[int]]:
    """Ids of pieces of 2 to ``width`` bytes (a power of two), by one segment
    tree each, all trees stepping together."""
    n = len(pieces)
    size = np.array([len(p) for p in pieces])
    data = np.zeros((n, width + 1), np.int64)
    used = np.arange(width) < size[:, None]
    data[:, :width][used] = np.frombuffer(b"".join(pieces), np.uint8)
    ids = vocabulary.byte_ids[data]
    position = np.arange(width + 1)
    after = np.tile(position + 1, (n, 1))
    before = np.tile(position - 1, (n, 1))
    tree = np.full((n, 2 * width), NONE)
    rank = vocabulary.pair_ranks(ids[:, :-1], ids[:, 1:])
    paired = (position[:width] + 1 < size[:, None]) & (rank != NONE)
    tree[:, width:] = np.where(paired, rank * width + position[:width], NONE)
    for node in range(width - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
    alive = used.copy()
    rows = np.flatnonzero(tree[:, 1] != NONE)
    levels = width.bit_length() - 1

    def put(r: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        node = width + at
        tree[r, node] = value
        for _ in range(levels):
            node = node >> 1
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])

    def rank_at(r: np.ndarray, at: np.ndarray) -> np.ndarray:
        other = after[r, at]
        found = vocabulary.pair_ranks(ids[r, at], ids[r, np.minimum(other, width)])
        return np.where((other < size[r]) & (found != NONE), found * width + at, NONE)

    while len(rows):
        least = tree[rows, 1]
        at, made = least % width, least // width
        gone = after[rows, at]
        ids[rows, at] = made
        alive[rows, gone] = False
        follow = after[rows, gone]
        after[rows, at] = follow
        before[rows, follow] = at
        put(rows, gone, np.full(len(rows), NONE))
        put(rows, at, rank_at(rows, at))
        left = before[rows, at]
        has = left >= 0
        put(rows[has], left[has], rank_at(rows[has], left[has]))
        rows = rows[tree[rows, 1] != NONE]
    flat, ends = ids[:, :width][alive].tolist(), np.cumsum(alive.sum(axis=1)).tolist()
    return [flat[s:e] for s, e in zip([0, *ends], ends)]


def merge_alone(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of one piece of any length, by its own segment tree."""
    n, pairs, shift = len(piece), vocabulary.pairs, vocabulary.shift
    width = 1 << (n - 1).bit_length()
    ids = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [NONE] * (2 * width)

    def key(at: int) -> int:
        other = after[at]
        made = pairs.get(ids[at] << shift | ids[other]) if other < n else None
        return NONE if made is None else made * width + at

    for i in range(n):
        tree[width + i] = key(i)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(at: int, value: int) -> None:
        node = width + at
        tree[node] = value
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            least = a if a < b else b
            if tree[node] == least:
                break
            tree[node] = least

    alive = bytearray(b"\x01") * n
    while tree[1] != NONE:
        made, at = divmod(tree[1], width)
        gone = after[at]
        ids[at], alive[gone] = made, 0
        after[at] = after[gone]
        if after[at] < n:
            before[after[at]] = at
        put(gone, NONE)
        put(at, key(at))
        if before[at] >= 0:
            put(before[at], key(before[at]))
    return [t for t, live in zip(ids, alive) if live]


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.pattern = regex.compile(pattern)
        self.spell = {i: f",{i}" for i in self.vocabulary.tokens}.__getitem__
        #: Ids of words as they stand behind one space, each as a comma and a number.
        self.words: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def pieces(self, pieces: Iterable[bytes]) -> dict[bytes, str]:
        """Spelled ids of distinct pieces, each checked by decoding."""
        ranks, out = self.vocabulary.ranks, {}
        by_width: dict[int, list[bytes]] = {}
        for p in pieces:
            if (whole := ranks.get(p)) is not None:
                out[p] = self.spell(whole)
            elif len(p) <= SIDE_BY_SIDE:
                by_width.setdefault(max(4, 1 << (len(p) - 1).bit_length()), []).append(p)
            else:
                out[p] = self.checked(p, merge_alone(p, self.vocabulary))
        for width, some in by_width.items():
            step = max(1, (1 << 19) // width)
            for i in range(0, len(some), step):
                block = some[i : i + step]
                out.update((p, self.checked(p, ids)) for p, ids in zip(block, merge_together(block, width, self.vocabulary)))
        return out

    def checked(self, piece: bytes, ids: list[int]) -> str:
        if self.decode(ids) != piece:
            raise ValueError(f"the ids of {piece!r} decode to something else")
        return "".join(map(self.spell, ids))

    def known(self, words: set[str]) -> set[str]:
        """Of ``words`` those that are not kept; those kept are made young."""
        if len(self.words) > KEPT_WORDS:
            self.older, self.words = self.words, {}
        missing = words.difference(self.words)
        again = missing.intersection(self.older)
        self.words.update(zip(again, map(self.older.__getitem__, again)))
        return missing - again

    def texts(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts."""
        return [numbers(spelled) for spelled, _ in self.spelled(texts)]

    def spelled(self, texts: list[str]) -> list[tuple[str, bool]]:
        """Ids of whole texts, each behind a comma, and whether they decode to the
        text. A space in front of a non-space starts a match in the patterns of
        published vocabularies (``pattern`` must do so too), so a text is taken
        word by word; one with more white space, or with a word that the pattern
        leaves something out of, is matched as a whole."""
        cut = [t.split(" ") for t in texts]
        find = self.pattern.findall
        unknown = self.known(set(chain.from_iterable(c[1:] for c in cut)))
        words = self.words
        matches: dict[str, list[bytes]] = {}
        whole: set[str] = set()  # words that do not stand by themselves
        for w in unknown:
            if not w or w[0].isspace() or "".join(found := find(" " + w)) != " " + w:
                whole.add(w)
            else:
                matches[w] = [p.encode() for p in found]
        heads, odd = [], set()
        for i, c in enumerate(cut):
            if whole and not whole.isdisjoint(c[1:]):
                head, cut[i] = texts[i], [""]
            else:
                head = c[0]
            found = find(head)
            if "".join(found) != head:
                odd.add(i)
            heads.append([p.encode() for p in found])
        ids = self.pieces(set(chain(chain.from_iterable(matches.values()), chain.from_iterable(heads))))
        get = ids.__getitem__
        once = []
        for w, found in matches.items():
            words[w] = get(found[0]) if len(found) == 1 else "".join(map(get, found))
            if len(w) > KEPT_LENGTH:
                once.append(w)
        out = [("".join(map(get, heads[i])) + "".join(map(words.__getitem__, c[1:])), i not in odd) for i, c in enumerate(cut)]
        for w in once:
            del words[w]
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


def numbers(spelled: str) -> list[int]:
    return [int(i) for i in spelled[1:].split(",")] if spelled else []


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """A worker's encoder, made once."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    for batch in batches:
        ids, texts, held = [], [], 0
        for i, t in zip(batch.column(0), batch.column(1)):
            ids.append(i.as_py())
            texts.append(t.as_py() or "")
            held += len(texts[-1])
            if held >= BLOCK:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def _encode(path: str, pattern: str, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for doc_ids, texts in _blocks(batches):
            rows = []
            for doc_id, text, (spelled, same) in zip(doc_ids, texts, e.spelled(texts)):
                ids = numbers(spelled) if with_ids or not same else []
                decoded = text.encode() if same else e.decode(ids)
                rows.append((doc_id, spelled.count(","), hashlib.sha256(spelled[1:].encode()).hexdigest(), hashlib.sha256(decoded).hexdigest(),
                             ids if with_ids else None))
            yield from arrow_rows(RESULT, rows).to_batches()

    return run


def byte_bpe(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids): ids of every text and
    what they decode to; ``ids`` is null unless ``with_ids``. ``path`` is a rank
    file that every executor has (or an installed package's)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_encode(path, pattern, with_ids), RESULT)
