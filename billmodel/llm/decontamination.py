"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item leaks into a document if at least ``threshold`` of the item's
different shingles (``shingle`` words; lower-cased words of Unicode letters and
digits, so case, punctuation and typographic marks don't hide a leak) are in the
document. Items are short and documents may be very long, so the share of the
*document* says nothing and signatures of whole documents would lose the items.

Items are therefore partitioned by size (their number of different shingles),
and an item's sketch is its bottom-k MinHash: the k least shingle hashes, where
k follows from the size: an item of n shingles that is contained to ``threshold``
misses at most ``n - ceil(threshold * n)`` of them, so one of its
``n - ceil(threshold * n) + 1`` least hashes must be in the document. Every
shingle hash of a document is looked up in the sketches, size class by size
class (a document with fewer shingles than a class needs skips it); hits are
candidates, and each is verified by the exact containment of shingle texts. The
search therefore finds every leak.

Items are the stated query set and go to the tasks in blocks of at most
``BLOCK_WORDS`` words, one pass over the documents each; documents are neither
shuffled nor collected.

Nulls and odd rows: a null or empty text has no shingles and neither leaks nor
is leaked into; an item of fewer words than a shingle is one shingle, of all its
words, and is searched for by that length in documents of any length; null ids
are kept; repeated rows (of items, too) give repeated results; extra columns are
ignored; without items, or without documents, the result is empty.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmodel.llm.common import CHUNK, Words, arrow_rows, rolled, ship_package

RESULT = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"
#: Words of items that are sent to the tasks at once.
BLOCK_WORDS = 2_000_000

_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Non-ASCII characters that are neither letters nor digits.
_MARK = re.compile(r"[^\x00-\x7f\w]")


def plain(text: str | None) -> str:
    """A text whose words are its runs of ASCII letters and digits and of
    non-ASCII characters."""
    text = (text or "").lower()
    return text if text.isascii() else _MARK.sub(" ", text)


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall(plain(text).encode())


def shingles(words: list[bytes], size: int) -> set[bytes]:
    """Different shingles of ``size`` words, as their text."""
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``size`` words, and the text each is of."""
    n = max(0, len(words.hashes) - size + 1)
    within = np.flatnonzero(words.doc[:n] == words.doc[size - 1 : size - 1 + n])
    return rolled(words.hashes, size)[within], words.doc[within]


class Sketches:
    """Bottom-k MinHash sketches of a block of items, by size class."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int, threshold: float):
        self.threshold = threshold
        cut = [(i, w) for i, t in items if (w := words_of(t))]
        #: (id, words of a shingle, shingles)
        self.items = [(i, min(size, len(w)), shingles(w, min(size, len(w)))) for i, w in cut]
        self.need = [self.needed(len(s)) for *_, s in self.items]
        #: shingle length -> classes: least number of shared shingles in it, sorted hashes, item of each, filter on low bits
        self.classes: dict[int, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]] = {}
        by_class: dict[tuple[int, int], list[int]] = {}
        for n, (_, length, s) in enumerate(self.items):
            by_class.setdefault((length, len(s).bit_length()), []).append(n)
        for (length, _), members in by_class.items():
            hashes, of = [], []
            for n in members:
                h = np.sort(shingle_hashes(Words(sorted(self.items[n][2]), _APART), length)[0])
                k = len(h) - self.need[n] + 1
                hashes.append(h[:k])
                of.append(np.full(k, n))
            flat, owner = np.concatenate(hashes), np.concatenate(of)
            order = np.argsort(flat, kind="stable")
            flat = flat[order]
            low = np.zeros(1 << max(16, (16 * len(flat)).bit_length()), bool)
            low[(flat & np.uint64(len(low) - 1)).astype(np.int64)] = True
            self.classes.setdefault(length, []).append((min(self.need[n] for n in members), flat, owner[order], low))

    def needed(self, n: int) -> int:
        return max(1, math.ceil(self.threshold * n - 1e-9))

    def candidates(self, words: Words, texts: int) -> set[tuple[int, int]]:
        """(text, item) pairs that share a sketch value."""
        out: set[tuple[int, int]] = set()
        for length, classes in self.classes.items():
            hashes, of = shingle_hashes(words, length)
            sizes = np.bincount(of, minlength=texts)
            for least, flat, owner, low in classes:
                hit = np.flatnonzero(low[(hashes & np.uint64(len(low) - 1)).astype(np.int64)])
                hit = hit[sizes[of[hit]] >= least]
                first, last = np.searchsorted(flat, hashes[hit], "left"), np.searchsorted(flat, hashes[hit], "right")
                for h, a, b in zip(hit[last > first].tolist(), first[last > first].tolist(), last[last > first].tolist()):
                    d = int(of[h])
                    out.update((d, i) for i in owner[a:b].tolist())
        return out

    def leaks(self, texts: list[str]) -> Iterator[tuple[int, int | None, int, int, float]]:
        """(text, item id, shingles, shared, containment) of verified leaks of
        ``plain`` texts."""
        last, own = -1, {}
        for d, i in sorted(self.candidates(Words([t.encode() for t in texts], _APART), len(texts))):
            if d != last:
                last, own, words = d, {}, words_of(texts[d])
            item_id, length, wanted = self.items[i]
            if length not in own:
                own[length] = shingles(words, length)
            shared = len(wanted & own[length])
            if shared >= self.need[i]:
                yield d, item_id, len(wanted), shared, shared / len(wanted)


def _search(sketches: Sketches):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held, rows = [], [], 0, []
            for i, t in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                texts.append(plain(t.as_py()))
                held += len(texts[-1])
                if held >= CHUNK:
                    rows += [(ids[d], *rest) for d, *rest in sketches.leaks(texts)]
                    ids, texts, held = [], [], 0
            rows += [(ids[d], *rest) for d, *rest in sketches.leaks(texts)]
            yield from arrow_rows(RESULT, rows).to_batches()

    return run


def _blocks(items: DataFrame, item_id_col: str, item_text_col: str, shingle: int, threshold: float) -> Iterator[Sketches]:
    """Sketches of the items, block by block."""
    wanted = items.select(F.col(f"`{item_id_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    words = wanted.agg(F.sum(F.size(F.split("text", " ")).cast("long"))).first()[0] or 0
    blocks = 1 + words // BLOCK_WORDS
    for b in range(blocks):
        block = wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield Sketches([tuple(r) for r in block.collect()], shingle, threshold)


def decontamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                    item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment): a row for each
    document and item that leaks into it."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    found = [rows.mapInArrow(_search(sketches), RESULT) for sketches in _blocks(items, item_id_col, item_text_col, shingle, threshold)]
    return reduce(DataFrame.unionByName, found)


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                  shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the rows that an item leaks into, by the same search."""
    ship_package(docs.sparkSession)

    def clean(sketches: Sketches):
        def run(column: pa.Array) -> pa.Array:
            out, texts, held = np.ones(len(column), bool), [], 0

            def flush(end: int) -> None:
                for d, *_ in sketches.leaks(texts):
                    out[end - len(texts) + d] = False

            for n, t in enumerate(column, 1):
                texts.append(plain(t.as_py()))
                held += len(texts[-1])
                if held >= CHUNK:
                    flush(n)
                    texts, held = [], 0
            flush(len(column))
            return pa.array(out)

        return F.arrow_udf(run, "boolean").asNondeterministic()

    for sketches in _blocks(items, item_id_col, item_text_col, shingle, threshold):
        docs = docs.filter(clean(sketches)(F.col(f"`{text_col}`").cast("string")))
    return docs
