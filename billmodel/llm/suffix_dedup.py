"""Exact byte-substring deduplication with longest-previous-factor arrays.

A window is ``length`` consecutive UTF-8 bytes of one document. A window that
starts at two or more places is repeated; bytes covered by repeated windows go:
all of them with ``keep="none"``, all but those of the first place (the smallest
document id, then the leftmost start) with ``keep="first"``. Windows are judged
on the input.

The corpus is too large for one suffix array, so its suffixes are dealt into
groups that can be sorted on their own:

1. Every window picks its winnowed anchor (see ``winnow``); equal windows pick
   equal anchors, so only windows with the same anchor need to be compared. The
   parts learn which anchors occur twice anywhere.
2. A stretch of windows with one repeated anchor is a segment of text. A part
   sends each different segment once, with its first place, to the anchor's
   bucket. There equal segments of several parts become one. Where an anchor
   still has different segments, they are laid end to end in the order of their
   first places and their suffixes sorted (prefix doubling, ``length`` bytes
   deep). Previous and next smaller positions in suffix order give the longest
   previous factor of each window start, and on the reversed order the longest
   next factor: a window with a previous factor of ``length`` is a later copy,
   one with a next factor only is a first copy.
   An anchor with more than ``HOT_SEGMENTS`` segments (a common phrase in ever
   other surroundings) would gather too much text in one group: its windows are
   sent one by one to the buckets of their own 64-bit fingerprints, where equal
   ones meet, a row a part at most.
3. The parts get one code a window back and cut the covered bytes out.

Nulls, ties and odd rows: a null text is empty; a null id counts as the largest
id; of places that tie (rows with the same id and text) each still counts as a
place, and the first of them by part order is kept by ``keep="first"``; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from billmodel.llm.common import (BYTE_VALUES, CHUNK, WORD_BASE, arrow_rows, deal_documents, dealt, id_array, is_in, mixed,
                                  ordered_ids, packed, part_documents, partitions, powers, unpacked)
from billmodel.llm.winnow import ANCHORS, SENT, TOLD, Matches, Seeds, part_of, told

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
SEGMENTS = "bucket int, part int, body binary, bytes binary"
CODES, HOT, HOT_FIRST, HOT_LATER = 2, 3, 4, 5
#: Segments of one anchor that are sorted in one group at most.
HOT_SEGMENTS = 50_000
UNIQUE, FIRST, LATER = 0, 1, 2


def _cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    return BYTE_VALUES[data], np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])


# --- suffix order and longest previous factors -------------------------------------


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int32)


class SuffixOrder:
    """Suffixes that start at ``starts`` in the order of their first ``depth``
    bytes (equal ones by position), with common prefixes of neighbours."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, depth: int):
        n = len(data)
        padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
        keys = np.zeros(n, np.uint64)
        for j in range(min(8, depth)):
            keys = (keys << np.uint64(8)) | padded[j : j + n].astype(np.uint64)
        levels, size = [_ranks(keys)], min(8, depth)
        while size * 2 <= depth:
            r = levels[-1].astype(np.int64)
            behind = np.concatenate([r[size:], np.full(min(size, n), -1)])
            levels.append(_ranks((r + 1) * (int(r.max()) + 2) + behind + 1))
            size *= 2
        top, rest = levels[-1], depth - size
        second = np.minimum(starts + rest, n - 1)
        self.order = np.lexsort((starts, top[second], top[starts]))
        self.at = starts[self.order]
        left, right = self.at[:-1], self.at[1:]
        # lcp with the suffix before, by the ranks of ever shorter blocks
        common = np.zeros(len(left), np.int64)
        width = size
        for ranks in levels[::-1]:
            for _ in range(2 if width == size else 1):
                a, b = left + common, right + common
                ok = (common + width <= depth) & (a < n) & (b < n)
                ok[ok] = ranks[a[ok]] == ranks[b[ok]]
                common += np.where(ok, width, 0)
            width //= 2
        for _ in range(min(8, depth)):
            a, b = np.minimum(left + common, n - 1), np.minimum(right + common, n - 1)
            ok = (common < depth) & (data[a] == data[b]) & (left + common < n) & (right + common < n)
            if not ok.any():
                break
            common += ok
        self.lcp = np.concatenate([[0], common])[: len(self.at)]

    def previous_factor(self) -> np.ndarray:
        """For each of ``starts``: the longest match (up to the depth) with a
        suffix that starts at a smaller position."""
        return self._factors(self.at)

    def next_factor(self) -> np.ndarray:
        """The same with suffixes that start at larger positions."""
        return self._factors(-self.at)

    def _factors(self, position: np.ndarray) -> np.ndarray:
        before = _common_with_smaller(position, self.lcp)
        turned = np.concatenate([[0], self.lcp[1:][::-1]])[: len(self.lcp)]
        after = _common_with_smaller(position[::-1], turned)[::-1]
        out = np.zeros(len(position), np.int64)
        out[self.order] = np.maximum(before, after)
        return out


def _common_with_smaller(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each element of a suffix order the common prefix with the nearest
    element before it that has a smaller position (0 if there is none): pointers
    jump over larger elements and carry the least common prefix passed."""
    to, common = np.arange(-1, len(position) - 1), lcp.copy()
    open_ = np.flatnonzero(to >= 0)
    while len(open_):
        open_ = open_[(position[to[open_]] > position[open_]) & (common[open_] > 0)]
        via = to[open_]
        common[open_] = np.minimum(common[open_], common[via])
        to[open_] = to[via]
        gone = to[open_] < 0
        common[open_[gone]] = 0
        open_ = open_[~gone]
    common[to < 0] = 0
    return common


# --- passes -------------------------------------------------------------------------


def _send_anchors(length: int, k: int, buckets: int):
    """Pass 1: a part's distinct anchors, each with its number of different
    segments; anchors that the part holds twice are marked."""

    def run(part_table: pa.Table) -> pa.Table:
        anchors, prints = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for _, texts in part_documents(part_table.column("docs")):
            values, doc = _cut(texts)
            seeds = Seeds(values, doc, length, k)
            sums = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(values * powers(WORD_BASE, len(values), "word"), out=sums[1:])
            undo = powers(pow(WORD_BASE, -1, 1 << 64), len(values), "unword")
            ends = seeds.last + length
            if len(ends):
                prints.append(mixed((sums[ends] - sums[seeds.first]) * undo[seeds.first]) + (ends - seeds.first).astype(np.uint64))
            anchors.append(seeds.anchor)
        a, p = np.concatenate(anchors), np.concatenate(prints)
        rows, part = [], part_of(part_table)
        if len(a):
            order = np.lexsort((p, a))
            a, p = a[order], p[order]
            head = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            other = np.concatenate([[True], (a[1:] != a[:-1]) | (p[1:] != p[:-1])])
            segments, times = np.add.reduceat(other.astype(np.uint64), head), np.diff(np.concatenate([head, [len(a)]]))
            for twice in (0, 1):
                some = np.flatnonzero((times > 1) == twice)
                rows += [(b, part, twice, packed(a[head][some[at]], segments[some[at]])) for b, at in dealt(a[head][some], buckets)]
        return arrow_rows(SENT, rows)

    return run


def _repeated(hot_segments: int):
    """The anchors of a bucket that occur twice or more, back to their parts;
    those with too many segments for one group apart."""

    def run(bucket: pa.Table) -> pa.Table:
        sent = [(p.as_py(), t.as_py(), unpacked(b.as_py(), 2)) for p, t, b in zip(bucket.column("part"), bucket.column("kind"), bucket.column("body"))]
        every, at = np.unique(np.concatenate([a for _, _, (a, _) in sent]), return_inverse=True)
        times, segments = np.zeros(len(every), np.int64), np.zeros(len(every), np.uint64)
        np.add.at(times, at, np.concatenate([np.full(len(a), 1 + t) for _, t, (a, _) in sent]))
        np.add.at(segments, at, np.concatenate([n for _, _, (_, n) in sent]))
        rows = []
        for kind, chosen in ((ANCHORS, every[(times > 1) & (segments <= hot_segments)]), (HOT, every[(times > 1) & (segments > hot_segments)])):
            rows += [(part, kind, packed(some)) for part, _, (a, _) in sent if len(some := a[is_in(a, chosen)])]
        return arrow_rows(TOLD, rows)

    return run


class _Segments:
    """The different segments around a part's repeated anchors, each with its
    first place. ``pieces`` and what goes with it is in the order of the segments
    themselves: the rows of a part may arrive in another order in another pass."""

    def __init__(self, part_table: pa.Table, repeated: np.ndarray, length: int, k: int):
        self.index: dict[bytes, int] = {}
        self.anchors: list[int] = []
        self.ids: list[int] = []
        self.starts: list[int] = []
        self.often: list[int] = []
        #: for each block of texts: (start in the block, segment, place) of its runs
        self.blocks: list[list[tuple[int, int, tuple[int, int]]]] = []
        for doc_ids, texts in part_documents(part_table.column("docs")):
            data, (values, doc) = b"".join(texts), _cut(texts)
            seeds = Seeds(values, doc, length, k)
            runs = np.flatnonzero(is_in(seeds.anchor, repeated))
            offset = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).tolist()
            ids, block = ordered_ids(id_array(doc_ids)).tolist(), []
            for f, t, a, d in zip(seeds.first[runs].tolist(), (seeds.last[runs] + length).tolist(), seeds.anchor[runs].tolist(), doc[seeds.first[runs]].tolist()):
                piece, place = data[f:t], (ids[d], f - offset[d])
                at = self.index.setdefault(piece, len(self.index))
                block.append((f, at, place))
                if at == len(self.anchors):
                    self.anchors.append(a)
                    self.ids.append(place[0])
                    self.starts.append(place[1])
                    self.often.append(0)
                else:
                    self.often[at] = 1
                    if place < (self.ids[at], self.starts[at]):
                        self.ids[at], self.starts[at] = place
            self.blocks.append(block)
        self.pieces = sorted(self.index)
        order = [self.index[p] for p in self.pieces]
        self.anchors, self.ids, self.starts, self.often = ([x[i] for i in order] for x in (self.anchors, self.ids, self.starts, self.often))
        moved = {old: new for new, old in enumerate(order)}
        self.blocks = [[(f, moved[at], place) for f, at, place in block] for block in self.blocks]


def _send_segments(length: int, k: int, buckets: int):
    def run(part_table: pa.Table, answers: pa.Table) -> pa.Table:
        if not part_table.num_rows:
            return arrow_rows(SEGMENTS, [])
        s = _Segments(part_table, told(answers, ANCHORS), length, k)
        pieces, anchors = s.pieces, np.array(s.anchors, np.uint64)
        ids, starts, often = (np.array(x, np.uint64) for x in (s.ids, s.starts, s.often))
        rows, part, press = [], part_of(part_table), zstandard.ZstdCompressor(level=1)
        for b, at in dealt(anchors, buckets):
            sizes = np.array([len(pieces[i]) for i in at], np.uint64)
            rows.append((b, part, packed(anchors[at], ids[at], starts[at], often[at], sizes), press.compress(b"".join(pieces[i] for i in at))))
        if len(hot := told(answers, HOT)):
            m = Matches(_cut, part_table, hot, length, k)
            first, _ = m.firsts()
            first = first[np.lexsort((m.starts[first], m.ids[first]))]
            several = is_in(m.prints[first], _more_than_once(m.prints)).astype(np.uint64)
            for b, at in dealt(m.prints[first], buckets):
                rows.append((b, part, packed(m.prints[first[at]], m.ids[first[at]], m.starts[first[at]], several[at]), None))
        return arrow_rows(SEGMENTS, rows)

    return run


def _more_than_once(values: np.ndarray) -> np.ndarray:
    """The different values that occur twice or more, sorted."""
    every, counts = np.unique(values, return_counts=True)
    return every[counts > 1]


def _code_hot_windows(bucket: pa.Table) -> list[tuple]:
    """For each part the fingerprints of its hot windows that are repeated: with
    the first place in this part, or with an earlier one in another."""
    parts, sent = bucket.column("part").to_pylist(), [unpacked(b.as_py(), 4) for b in bucket.column("body")]
    prints, ids, starts, several = (np.concatenate([s[i] for s in sent]) for i in range(4))
    of = np.repeat(np.arange(len(sent)), [len(s[0]) for s in sent])
    order = np.lexsort((of, starts, ids, prints))
    new = np.concatenate([[True], prints[order][1:] != prints[order][:-1]])
    repeated = is_in(prints, np.union1d(_more_than_once(prints), prints[several > 0]))
    is_first = np.zeros(len(prints), bool)
    is_first[order[new]] = True
    rows = []
    for kind, chosen in ((HOT_FIRST, repeated & is_first), (HOT_LATER, repeated & ~is_first)):
        chosen = np.flatnonzero(chosen)
        rows += [(parts[n], kind, packed(np.sort(prints[chosen[at]]))) for n, at in dealt(of[chosen].astype(np.uint64), len(sent))]
    return rows


def _code_windows(length: int):
    """Pass 2 in a bucket: a code for every window of every segment sent."""

    def run(bucket: pa.Table) -> pa.Table:
        press, unpress = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        alone = pc.is_null(bucket.column("bytes"))
        hot_rows = _code_hot_windows(hot) if (hot := bucket.filter(alone)).num_rows else []
        bucket = bucket.filter(pc.invert(alone))
        # piece -> number, first place (id, start, part row, row in it), all that sent it
        number: dict[bytes, int] = {}
        anchor, first, owner, senders, often, sizes = [], [], [], [], [], []
        parts = [p.as_py() for p in bucket.column("part")]
        order = np.argsort(parts, kind="stable").tolist()
        for r in order:
            anchors, ids, starts, many, lengths = (x.tolist() for x in unpacked(bucket.column("body")[r].as_py(), 5))
            raw = unpress.decompress(bucket.column("bytes")[r].as_py())
            end, mine = 0, []
            for a, i, s, m, n in zip(anchors, ids, starts, many, lengths):
                piece = raw[end : end + n]
                end += n
                at = number.setdefault(piece, len(number))
                if at == len(anchor):
                    anchor.append(a)
                    first.append((i, s))
                    owner.append(r)
                    often.append(m)
                    sizes.append(n)
                else:
                    often[at] = 1
                    if (i, s) < first[at]:
                        first[at], owner[at] = (i, s), r
                mine.append(at)
            senders.append((r, mine))
        pieces = list(number)
        del number
        # a segment that stands alone with its anchor needs no sorting
        codes: list = [FIRST if m else UNIQUE for m in often]
        keys = np.array(anchor, np.uint64)
        ids, starts = np.array([f[0] for f in first], np.uint64), np.array([f[1] for f in first], np.uint64)
        by = np.lexsort((starts, ids, keys))
        edges = np.flatnonzero(np.concatenate([[True], keys[by][1:] != keys[by][:-1], [True]]))
        batch, held = [], 0
        for s, e in zip(edges[:-1], edges[1:]):
            if e - s > 1:
                group = by[s:e].tolist()
                batch.append(group)
                held += sum(sizes[i] for i in group)
                if held >= CHUNK:
                    _sort_segments(batch, pieces, ids, starts, often, codes, length)
                    batch, held = [], 0
        if batch:
            _sort_segments(batch, pieces, ids, starts, often, codes, length)
        rows = hot_rows
        for r, mine in senders:
            heads, bodies = bytearray(), []
            for at in mine:
                code = codes[at]
                if owner[at] == r:
                    if isinstance(code, int):
                        heads.append(code)
                    else:
                        heads.append(3)
                        bodies.append(code)
                else:
                    heads.append(LATER)
            rows.append((parts[r], CODES, bucket.column("bucket")[r].as_py().to_bytes(4, "little") + press.compress(bytes(heads) + b"".join(bodies))))
        return arrow_rows(TOLD, rows)

    return run


def _sort_segments(groups, pieces, ids, starts, often, codes, length) -> None:
    """Codes of segments that share anchors, from one suffix order."""
    members = np.array([i for g in groups for i in g])
    members = members[np.lexsort((starts[members], ids[members]))]  # text order is corpus order
    text = np.frombuffer(b"".join(pieces[i] for i in members), np.uint8)
    sizes = np.array([len(pieces[i]) for i in members])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    windows = sizes - length + 1
    edge = np.concatenate([[0], np.cumsum(windows)])
    at = np.arange(edge[-1]) + np.repeat(begin - edge[:-1], windows)
    suffixes = SuffixOrder(text, at, length)
    later = suffixes.previous_factor() >= length
    again = suffixes.next_factor() >= length
    again |= np.repeat(np.array([often[i] for i in members], bool), windows)
    code = np.where(later, LATER, np.where(again, FIRST, UNIQUE)).astype(np.uint8)
    least, most = np.minimum.reduceat(code, edge[:-1]).tolist(), np.maximum.reduceat(code, edge[:-1]).tolist()
    for n, i in enumerate(members.tolist()):
        codes[i] = least[n] if least[n] == most[n] else code[edge[n] : edge[n + 1]].tobytes()


def _covered(code: int | np.ndarray, least: int, windows: int, length: int) -> list[tuple[int, int]]:
    """Stretches of a segment under windows whose code is ``least`` or more."""
    if isinstance(code, int):
        return [(0, windows - 1 + length)] if code >= least else []
    hit = np.flatnonzero(code >= least)
    if not len(hit):
        return []
    new = np.flatnonzero(np.diff(hit) > 1)
    return list(zip(hit[np.concatenate([[0], new + 1])].tolist(), (hit[np.concatenate([new, [-1]])] + length).tolist()))


def _cut_out(length: int, k: int, keep_first: bool, buckets: int, with_bytes: bool):
    """Pass 3: cut the bytes that repeated windows cover."""

    def run(part_table: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if not part_table.num_rows:
            return arrow_rows(RESULT, out)
        repeated = told(answers, ANCHORS)
        s = _Segments(part_table, repeated, length, k)
        codes: list = [UNIQUE] * len(s.pieces)
        bodies = {int.from_bytes((raw := b.as_py())[:4], "little"): raw[4:] for kind, b in zip(answers.column("kind"), answers.column("body")) if kind.as_py() == CODES}
        for b, at in dealt(np.array(s.anchors, np.uint64), buckets):
            raw = zstandard.ZstdDecompressor().decompress(bodies[b])
            end = len(at)
            for n, i in enumerate(at.tolist()):
                if raw[n] == 3:
                    size = len(s.pieces[i]) - length + 1
                    codes[i] = np.frombuffer(raw, np.uint8, size, end)
                    end += size
                else:
                    codes[i] = raw[n]
        hot = told(answers, HOT)
        first, later = told(answers, HOT_FIRST), told(answers, HOT_LATER)
        m = Matches(_cut, part_table, hot, length, k) if len(hot) else None
        if m:
            # the part's first place of a window is the corpus's first, or goes like the others
            goes = is_in(m.prints, later) | (is_in(m.prints, first) & ~(m.firsts()[1] & keep_first))
        taken = 0
        usual = [_covered(c, FIRST, len(p) - length + 1, length) for c, p in zip(codes, s.pieces)]
        places = list(zip(s.ids, s.starts))
        for (doc_ids, texts), block in zip(part_documents(part_table.column("docs")), s.blocks):
            froms, tos = [], []
            for f, i, place in block:
                cut = usual[i]
                if cut and keep_first and place == places[i]:  # the part's first place of this segment
                    cut, places[i] = _covered(codes[i], LATER, len(s.pieces[i]) - length + 1, length), None
                for a, b in cut:
                    froms.append(f + a)
                    tos.append(f + b)
            data = b"".join(texts)
            offset = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).tolist()
            if m:
                values, doc = _cut(texts)
                seeds = Seeds(values, doc, length, k)
                at = seeds.windows(np.flatnonzero(is_in(seeds.anchor, hot)))
                hit = at[goes[taken : taken + len(at)]]
                taken += len(at)
                froms += hit.tolist()
                tos += (hit + length).tolist()
            cover = np.zeros(len(data) + 1, np.int32)
            np.add.at(cover, froms, 1)
            np.add.at(cover, tos, -1)
            covered = np.cumsum(cover[:-1]) > 0
            every = np.frombuffer(data, np.uint8)
            for d, text in enumerate(texts):
                gone = covered[offset[d] : offset[d + 1]]
                n = int(gone.sum())
                kept = every[offset[d] : offset[d + 1]][~gone].tobytes() if n else text
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                out.append((doc_ids[d], len(text), n, spans, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
        return arrow_rows(RESULT, out)

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                 anchor_bytes: int = 64, keep: str = "first", with_bytes: bool = False, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): one row per row
    of ``docs``; ``kept`` (the remaining bytes) is null unless ``with_bytes``."""
    if keep not in ("first", "none"):
        raise ValueError("keep must be 'first' or 'none'")
    if not 8 <= anchor_bytes <= length:
        raise ValueError("anchor_bytes must be between 8 and length")
    n = partitions(docs.sparkSession)
    parts = deal_documents(docs, id_col, text_col, n)
    anchors = (parts.groupBy("part").applyInArrow(_send_anchors(length, anchor_bytes, n), SENT)
               .groupBy("bucket").applyInArrow(_repeated(hot_segments), TOLD))
    codes = (parts.groupBy("part").cogroup(anchors.groupBy("part"))
             .applyInArrow(_send_segments(length, anchor_bytes, n), SEGMENTS)
             .groupBy("bucket").applyInArrow(_code_windows(length), TOLD))
    both = anchors.unionByName(codes)
    return (parts.groupBy("part").cogroup(both.groupBy("part"))
            .applyInArrow(_cut_out(length, anchor_bytes, keep == "first", n, with_bytes), RESULT))
