"""Winnowed anchors, and the exchange that tells each part of a corpus which of
its anchors occur twice or more anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from billmodel.llm.common import arrow_rows, dealt, id_array, is_in, ordered_ids, packed, part_documents, rolled, sliding_min, unpacked

SENT = "bucket int, part int, kind int, body binary"
TOLD = "part int, kind int, body binary"
ANCHORS = 1


class Seeds:
    """Winnowed anchors of sequences laid end to end. Every window of ``length``
    values within one sequence picks the ``k``-gram in it with the least hash
    (the first of equals), so equal windows pick equal anchors. A run is a
    stretch of windows that pick the same anchor."""

    def __init__(self, values: np.ndarray, doc: np.ndarray, length: int, k: int):
        self.values, self.length = values, length
        n = len(values) - length + 1
        self.first = self.last = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        if n <= 0:
            return
        grams = rolled(values, k)
        keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        picked = (sliding_min(keyed, length - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        whole = np.flatnonzero(doc[:n] == doc[length - 1 :])
        if not len(whole):
            return
        picked = picked[whole]
        new = np.flatnonzero(np.concatenate([[True], picked[1:] != picked[:-1]]))
        self.first = whole[new]
        self.last = whole[np.concatenate([new[1:], [len(whole)]]) - 1]
        self.anchor = grams[picked[new]]

    def windows(self, chosen: np.ndarray) -> np.ndarray:
        """Starts of the windows of the chosen runs, in order."""
        first, count = self.first[chosen], self.last[chosen] - self.first[chosen] + 1
        total = int(count.sum())
        if not total:
            return np.zeros(0, np.int64)
        return np.arange(total) + np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)


def part_of(table: pa.Table) -> int:
    return table.column("part")[0].as_py()


def told(answers: pa.Table, kind: int) -> np.ndarray:
    """Sorted hashes that the buckets told a part about."""
    got = [unpacked(b.as_py())[0] for k, b in zip(answers.column("kind"), answers.column("body")) if k.as_py() == kind]
    return np.sort(np.concatenate(got)) if got else np.zeros(0, np.uint64)


def send_anchors(cut, length: int, k: int, buckets: int):
    """The distinct anchors of a part, with those that it holds twice marked.
    ``cut`` makes (values, document number of each) from a list of texts."""

    def run(part_table: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for _, texts in part_documents(part_table.column("docs")):
            found.append(Seeds(*cut(texts), length, k).anchor)
        anchors, counts = np.unique(np.concatenate(found), return_counts=True)
        rows, part = [], part_of(part_table)
        for twice in (0, 1):
            some = anchors[(counts > 1) == twice]
            rows += [(b, part, twice, packed(some[at])) for b, at in dealt(some, buckets)]
        return arrow_rows(SENT, rows)

    return run


def repeated_anchors(bucket: pa.Table) -> pa.Table:
    """The anchors of a bucket that occur twice or more, back to their parts."""
    sent = [(p.as_py(), t.as_py(), unpacked(b.as_py())[0]) for p, t, b in zip(bucket.column("part"), bucket.column("kind"), bucket.column("body"))]
    every, counts = np.unique(np.concatenate([a for _, _, a in sent]), return_counts=True)
    twice = np.concatenate([np.zeros(0, np.uint64), *(a for _, t, a in sent if t)])
    repeated = np.union1d(every[counts > 1], twice)
    rows = []
    for part, _, anchors in sent:
        if len(some := anchors[is_in(anchors, repeated)]):
            rows.append((part, ANCHORS, packed(some)))
    return arrow_rows(TOLD, rows)


class Matches:
    """Windows around a part's repeated seeds: fingerprints and places, chunk by
    chunk, and which of them are the part's first of their fingerprint."""

    def __init__(self, cut, part_table: pa.Table, repeated: np.ndarray, length: int, k: int):
        prints, ids, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for doc_ids, texts in part_documents(part_table.column("docs")):
            values, doc = cut(texts)
            seeds = Seeds(values, doc, length, k)
            at = seeds.windows(np.flatnonzero(is_in(seeds.anchor, repeated)))
            if len(at):
                prints.append(rolled(values, length)[at])
                ids.append(ordered_ids(id_array(doc_ids))[doc[at]])
                starts.append(at - np.searchsorted(doc, doc[at]))
        self.prints, self.ids, self.starts = np.concatenate(prints), np.concatenate(ids), np.concatenate(starts)

    def firsts(self) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first place of each fingerprint, and for every window
        whether its place is that first one."""
        order = np.lexsort((self.starts, self.ids, self.prints))
        p, i, s = self.prints[order], self.ids[order], self.starts[order]
        new = np.concatenate([[True], p[1:] != p[:-1]])[: len(p)]
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        same = (i == i[head][group]) & (s == s[head][group]) if len(p) else np.zeros(0, bool)
        is_first = np.zeros(len(p), bool)
        is_first[order] = same
        return order[head], is_first
