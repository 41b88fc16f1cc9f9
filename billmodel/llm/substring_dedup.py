"""Substring deduplication by seed and extend.

A window is ``length`` consecutive words of one document. Words covered by a
window whose word sequence also starts earlier (a smaller document id, or the
same document further left) go; windows are judged on the input.

Three passes over the documents, dealt once into parts:

1. *Seeds.* Every window picks its winnowed anchor (the ``k``-gram of words with
   the least hash), so equal windows have equal anchors. Each part sends its
   distinct anchors, a bucket of anchors meets in one group, and the parts learn
   which of theirs occur twice or more anywhere (the join on anchors; a part
   sends an anchor once however often it holds it, so a passage of a third of
   all documents is as many rows as there are parts).
2. *Extend.* From each repeated seed the match is carried to the left and right
   as far as windows around it recur: the fingerprints of the windows that own
   the seed are sent with their first place in the part, and the bucket answers
   with those that have an earlier place in another part.
3. *Maximal repeats.* Overlapping matched windows join into maximal repeats (all
   at least ``length`` words); their words are removed.

Nulls, ties and odd rows: a null text has no words; a null id counts as the
largest id; rows with the same id share one place, so of two rows with the same
id and text neither is earlier than the other; extra columns are ignored; an
empty table gives an empty result. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from billmodel.llm.common import Words, arrow_rows, deal_documents, dealt, is_in, packed, part_documents, partitions, unpacked
from billmodel.llm.winnow import ANCHORS, SENT, TOLD, Matches, Seeds, part_of, repeated_anchors, send_anchors, told

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
EARLIER = 2


def _cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts)
    return words.hashes, words.doc


def _send_windows(length: int, k: int, buckets: int):
    """Pass 2: the first place in this part of every window around a seed."""

    def run(part_table: pa.Table, answers: pa.Table) -> pa.Table:
        if not part_table.num_rows:
            return arrow_rows(SENT, [])
        m = Matches(_cut, part_table, told(answers, ANCHORS), length, k)
        first, _ = m.firsts()
        first = first[np.lexsort((m.starts[first], m.ids[first]))]
        rows, part = [], part_of(part_table)
        for b, at in dealt(m.prints[first], buckets):
            at = first[at]
            rows.append((b, part, 0, packed(m.prints[at], m.ids[at], m.starts[at])))
        return arrow_rows(SENT, rows)

    return run


def _earlier_elsewhere(bucket: pa.Table) -> pa.Table:
    """For each part the fingerprints that have an earlier place in another."""
    parts, sent = [p.as_py() for p in bucket.column("part")], [unpacked(b.as_py(), 3) for b in bucket.column("body")]
    prints, ids, starts = (np.concatenate([s[i] for s in sent]) for i in range(3))
    of = np.repeat(np.arange(len(sent)), [len(s[0]) for s in sent])
    order = np.lexsort((starts, ids, prints))
    p, i, s = prints[order], ids[order], starts[order]
    new = np.concatenate([[True], p[1:] != p[:-1]])
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = order[(i != i[head]) | (s != s[head])]
    rows = []
    for n, at in dealt(of[later].astype(np.uint64), len(sent)):
        rows.append((parts[n], EARLIER, packed(np.sort(prints[later[at]]))))
    return arrow_rows(TOLD, rows)


def _remove_repeats(length: int, k: int, with_text: bool):
    """Pass 3: join matched windows into maximal repeats and cut them out."""

    def run(part_table: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if not part_table.num_rows:
            return arrow_rows(RESULT, out)
        repeated, earlier = told(answers, ANCHORS), told(answers, EARLIER)
        m = Matches(_cut, part_table, repeated, length, k)
        _, is_first = m.firsts()
        gone = ~is_first | is_in(m.prints, earlier)
        taken = 0
        for doc_ids, texts in part_documents(part_table.column("docs")):
            words = Words(texts)
            seeds = Seeds(words.hashes, words.doc, length, k)
            at = seeds.windows(np.flatnonzero(is_in(seeds.anchor, repeated)))
            cut = at[gone[taken : taken + len(at)]]
            taken += len(at)
            cover = np.zeros(len(words.hashes) + 1, np.int64)
            np.add.at(cover, cut, 1)
            np.add.at(cover, cut + length, -1)
            covered = np.cumsum(cover[:-1]) > 0
            bounds = np.searchsorted(words.doc, np.arange(len(texts) + 1))
            removed = np.concatenate([[0], np.cumsum(covered)])
            for d, text in enumerate(texts):
                s, e = bounds[d], bounds[d + 1]
                kept = text.split()
                if n := int(removed[e] - removed[s]):
                    kept = [kept[j] for j in np.flatnonzero(~covered[s:e])]
                joined = b" ".join(kept)
                out.append((doc_ids[d], int(e - s), n, hashlib.sha256(joined).hexdigest(), joined.decode() if with_text else None))
        return arrow_rows(RESULT, out)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20,
                    anchor_words: int = 8, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text): one row per row of
    ``docs``. ``kept_text`` (the kept words joined by one space) is null unless
    ``with_text``. See the module's text for the method and odd rows."""
    if not 1 <= anchor_words <= length:
        raise ValueError("anchor_words must be between 1 and length")
    n = partitions(docs.sparkSession)
    parts = deal_documents(docs, id_col, text_col, n)
    anchors = (parts.groupBy("part").applyInArrow(send_anchors(_cut, length, anchor_words, n), SENT)
               .groupBy("bucket").applyInArrow(repeated_anchors, TOLD))
    earlier = (parts.groupBy("part").cogroup(anchors.groupBy("part"))
               .applyInArrow(_send_windows(length, anchor_words, n), SENT)
               .groupBy("bucket").applyInArrow(_earlier_elsewhere, TOLD))
    both = anchors.unionByName(earlier)
    return (parts.groupBy("part").cogroup(both.groupBy("part"))
            .applyInArrow(_remove_repeats(length, anchor_words, with_text), RESULT))
