"""Stupid-backoff language-model scores of every document under the others.

The model is the corpus itself: n-grams of its words up to ``order``, counted
over all documents. A word scores the relative frequency of the longest n-gram
that ends in it and that occurs *outside its own document* (counts less the
document's own, so that a text does not vouch for itself), times ``backoff`` for
every order given up; a word that occurs nowhere else scores as half a word. A
document's score is the sum of the logarithms.

Relationally: n-gram count tables, partitioned by hash, are joined to the
n-grams of the documents and summed per document. The documents are dealt into
parts once; a part sends each different n-gram once with its count (a word of a
third of all text is a row per part), a bucket adds the counts up and answers
each part in the part's own order, and the parts score their documents. An
n-gram of three or more words can occur elsewhere only if both n-grams inside it
do, so higher orders are sent only where the order below found them elsewhere;
nothing that could count is left out. N-grams are compared by 64-bit hashes.

Nulls and odd rows: a null or blank text has no words, score 0 and no mean; a
null id stays null; rows with the same id and text are documents of their own
and see each other; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from billmodel.llm.common import Words, arrow_rows, deal_documents, dealt, packed, part_documents, partitions, rolled, unpacked
from billmodel.llm.winnow import part_of

RESULT = "doc_id long, n_words long, score double, mean_score double"
COUNTS = "bucket int, part int, kind int, body binary"
ANSWERS = "part int, kind int, bucket int, body binary"
BACKOFF = 0.4
#: Kind of the rows that carry numbers of words instead of n-gram counts.
WORDS = 0


class _Part:
    """The words of a part, and its n-grams order by order."""

    def __init__(self, part_table: pa.Table):
        self.ids: list[int | None] = []
        hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for ids, texts in part_documents(part_table.column("docs")):
            words = Words(texts)
            hashes.append(words.hashes)
            docs.append(words.doc + len(self.ids))
            self.ids += ids
        self.hashes, self.doc = np.concatenate(hashes), np.concatenate(docs)

    def grams(self, n: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(place of the last word, hash) of the n-grams within documents, or of
        those that end at ``at``."""
        if at is None:
            ends = np.arange(n - 1, len(self.hashes))
            at = ends[self.doc[ends] == self.doc[ends - (n - 1)]]
        return at, rolled(self.hashes, n)[at - (n - 1)] if len(at) else np.zeros(0, np.uint64)

    def outside(self, number: np.ndarray, at: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """How often each n-gram (by its number) occurs outside the document of its
        place. Only those that the part holds more than once can be in their
        document twice; they alone are sorted by document."""
        own = np.ones(len(number), np.int64)
        again = np.flatnonzero((np.bincount(number, minlength=len(totals)) > 1)[number])
        key = self.doc[at[again]] * max(1, len(totals)) + number[again]
        order = np.argsort(key)
        new = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))[: len(key)]
        sizes = np.diff(np.concatenate([new, [len(key)]]))
        own[again[order]] = np.repeat(sizes, sizes)
        return totals[number].astype(np.int64) - own


def _sent(counted: np.ndarray, counts: np.ndarray, n: int, part: int, buckets: int) -> list[tuple]:
    return [(b, part, n, _pair(counted[at], counts[at])) for b, at in dealt(counted, buckets)]


def _pair(counted: np.ndarray, counts: np.ndarray) -> bytes:
    a, b = packed(counted), packed(counts, steps=False)
    return len(a).to_bytes(4, "little") + a + b


def _unpair(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(body[:4], "little")
    return unpacked(body[4 : 4 + n])[0], unpacked(body[4 + n :], steps=False)[0]


def _totals(answers: pa.Table, counted: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Counts of all documents for the part's sorted n-grams of one order."""
    bodies = {b.as_py(): x.as_py() for k, b, x in zip(answers.column("kind"), answers.column("bucket"), answers.column("body")) if k.as_py() == n}
    out = np.zeros(len(counted), np.uint64)
    for b, at in dealt(counted, buckets):
        out[at] = unpacked(bodies[b], steps=False)[0]
    return out


def _count_low(order: int, buckets: int):
    """Counts of words and pairs, and the number of words."""

    def run(part_table: pa.Table) -> pa.Table:
        p, part = _Part(part_table), part_of(part_table)
        rows = [(0, part, WORDS, len(p.hashes).to_bytes(8, "little"))]
        for n in range(1, min(order, 2) + 1):
            counted, counts = np.unique(p.grams(n)[1], return_counts=True)
            rows += _sent(counted, counts, n, part, buckets)
        return arrow_rows(COUNTS, rows)

    return run


class _Known:
    """Places of a part's n-grams that occur outside their document, by order."""

    def __init__(self, p: _Part, answers: pa.Table, orders: int, buckets: int):
        self.at: list[np.ndarray] = []
        self.count: list[np.ndarray] = []
        at = None
        for n in range(1, orders + 1):
            at, grams = p.grams(n, at)
            counted, number = np.unique(grams, return_inverse=True)
            outside = p.outside(number, at, _totals(answers, counted, n, buckets)) if len(at) else np.zeros(0, np.int64)
            self.at.append(at[outside > 0])
            self.count.append(outside[outside > 0])
            at = None if n < 2 else self.next(p, n)

    def next(self, p: _Part, n: int) -> np.ndarray:
        """Where an n-gram one longer may occur elsewhere: both n-grams in it do."""
        ends = self.at[n - 1]
        known = np.zeros(len(p.hashes) + 1, bool)
        known[ends] = True
        both = ends[known[ends - 1]]  # (the last entry, of place -1, stays false)
        both = both[both >= n]
        return both[p.doc[both] == p.doc[both - n]]


def _count_high(n: int, buckets: int):
    """Counts of the n-grams that may occur elsewhere."""

    def run(part_table: pa.Table, answers: pa.Table) -> pa.Table:
        if not part_table.num_rows:
            return arrow_rows(COUNTS, [])
        p = _Part(part_table)
        known = _Known(p, answers, n - 1, buckets)
        counted, counts = np.unique(p.grams(n, known.next(p, n - 1))[1], return_counts=True)
        return arrow_rows(COUNTS, _sent(counted, counts, n, part_of(part_table), buckets))

    return run


def _add_up(bucket: pa.Table) -> pa.Table:
    """Total counts of a bucket's n-grams, to each part in its own order."""
    rows, parts = [], bucket.column("part").to_pylist()
    kinds, number = bucket.column("kind").to_pylist(), bucket.column("bucket").to_pylist()
    bodies = bucket.column("body")
    for kind in sorted(set(kinds)):
        mine = [i for i, k in enumerate(kinds) if k == kind]
        if kind == WORDS:
            total = sum(int.from_bytes(bodies[i].as_py(), "little") for i in mine)
            rows += [(parts[i], WORDS, 0, total.to_bytes(8, "little")) for i in mine]
            continue
        sent = [_unpair(bodies[i].as_py()) for i in mine]
        every, at = np.unique(np.concatenate([s[0] for s in sent]), return_inverse=True)
        totals = np.zeros(len(every), np.uint64)
        np.add.at(totals, at, np.concatenate([s[1] for s in sent]))
        end = 0
        for i, (counted, _) in zip(mine, sent):
            rows.append((parts[i], kind, number[i], packed(totals[at[end : end + len(counted)]], steps=False)))
            end += len(counted)
    return arrow_rows(ANSWERS, rows)


def _score(order: int, backoff: float, buckets: int):
    def run(part_table: pa.Table, answers: pa.Table) -> pa.Table:
        if not part_table.num_rows:
            return arrow_rows(RESULT, [])
        p = _Part(part_table)
        known = _Known(p, answers, order, buckets)
        words = next(int.from_bytes(b.as_py(), "little") for k, b in zip(answers.column("kind"), answers.column("body")) if k.as_py() == WORDS)
        sizes = np.bincount(p.doc, minlength=len(p.ids))
        elsewhere = np.maximum(words - sizes, 1)[p.doc]
        level = np.zeros(len(p.hashes))
        level[:] = np.log(0.5 / elsewhere)
        below = np.zeros(len(p.hashes), np.int64)  # count of the n-gram one shorter, by its last place
        for n, (at, count) in enumerate(zip(known.at, known.count), 1):
            if n == 1:
                level[at] = np.log(count / elsewhere[at])
            else:
                level[at] = np.log(count / below[at - 1])
            # whatever this order does not know has given it up
            level += np.log(backoff) * (n > 1)
            level[at] -= np.log(backoff) * (n > 1)
            below = np.zeros(len(p.hashes), np.int64)
            below[at] = count
        sums = np.bincount(p.doc, weights=level, minlength=len(p.ids))
        rows = [(i, int(n), round(float(s), 6), round(float(s) / int(n), 6) if n else None) for i, n, s in zip(p.ids, sizes, sums)]
        return arrow_rows(RESULT, rows)

    return run


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3, backoff: float = BACKOFF) -> DataFrame:
    """(doc_id, n_words, score, mean_score): one row per row of ``docs``; words
    are as they stand, separated by white space."""
    if order < 1:
        raise ValueError("order must be 1 or more")
    n = partitions(docs.sparkSession)
    parts = deal_documents(docs, id_col, text_col, n)
    answers = parts.groupBy("part").applyInArrow(_count_low(order, n), COUNTS).groupBy("bucket").applyInArrow(_add_up, ANSWERS)
    for high in range(3, order + 1):
        sent = parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_count_high(high, n), COUNTS)
        answers = answers.unionByName(sent.groupBy("bucket").applyInArrow(_add_up, ANSWERS))
    return parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_score(order, backoff, n), RESULT)
