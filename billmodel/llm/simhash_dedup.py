"""SimHash near-duplicates, with pivot distance tables.

A text's words (A-Z lower-cased) give shingles of ``shingle`` words, repeats
included; a fingerprint bit is 1 if it is set in over half of the shingles'
XXH64 hashes (seed 42). Fingerprints that differ in at most ``bits`` bits link,
and links make groups.

Each different fingerprint is one row from here on, however many texts have it.
Where to look: ``bits + 1`` blocks cannot all differ, so linked fingerprints
agree on a block and, by the same argument over the other bits, on a part of
the rest; each (block, part) value is a bucket, and buckets are swept in their
shuffled partitions. What to compare: a table of distances to many fixed
reference fingerprints (pivots). By the triangle inequality a pair whose
distances to some pivot differ by more than ``bits`` cannot link: the members of
a bucket are sorted by the first distance, neighbours within ``bits`` of it are
paired, and pairs are discarded pivot by pivot on the largest coordinate
difference. Survivors are verified bit by bit. A bucket that is too large for a
sweep is split once more by parts of the bits left (never cut off). A task
hands on a spanning forest of the links it found, not all of them, and the
groups are the connected components.

Nulls, ties and odd rows: a null, empty or blank text has the fingerprint zero,
linked like any other; a text of fewer words than a shingle is one shingle; a
null id takes part in links, but ``component_id`` is the least id that is not
null (null if there is none); repeated rows give repeated results; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billmodel.llm.common import CHUNK, arrow_rows, arrow_schema, checkpointed, join_counted, mixed, partitions, ship_package
from billmodel.llm.components import components

FINGERPRINTS = "doc_id long, fp long"
LINKS = "a long, b long"
#: Reference fingerprints; members of a bucket that are swept pairwise at most.
PIVOTS = 48
SWEPT = 512


# --- fingerprints -------------------------------------------------------------------


def _shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()
    if len(words) >= shingle:
        words = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    elif words:
        words = [b" ".join(words)]
    return [xxhash.xxh64_intdigest(w, 42) for w in words]


def fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint a text."""
    hashes = [_shingle_hashes(t, shingle) for t in texts]
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(sizes.sum()))
        bits = np.unpackbits(flat.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        major = (2 * counts > sizes[some, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(FINGERPRINTS)
        for batch in batches:
            column, texts, held, made = batch.column(1).cast(pa.large_binary()), [], 0, []
            for t in column:
                texts.append(t.as_py() or b"")
                held += len(texts[-1])
                if held >= CHUNK:
                    made.append(fingerprints(texts, shingle))
                    texts, held = [], 0
            made.append(fingerprints(texts, shingle))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(made).view(np.int64))], schema=schema)

    return run


# --- links ----------------------------------------------------------------------------


def _blocks(width: int, parts: int) -> list[tuple[int, int]]:
    """``width`` bits as ``parts`` runs (first bit, length)."""
    edges = [width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def bucket_keys(bits: int) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """Bit positions of each bucket table: of a block, and of a part of the rest."""
    out = []
    for a, n in _blocks(64, bits + 1):
        block = tuple(range(a, a + n))
        rest = [i for i in range(64) if i not in block]
        out += [(block, tuple(rest[b : b + m])) for b, m in _blocks(len(rest), bits + 1)]
    return out


def _field(values: np.ndarray, positions: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(values), np.uint64)
    for to, at in enumerate(positions):
        out |= ((values >> np.uint64(at)) & np.uint64(1)) << np.uint64(to)
    return out


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints: no bits, all low bits of a half, a quarter ...
    and mixed ones."""
    plain = [0, 0xFFFFFFFF, 0xFFFF0000FFFF, 0xFF00FF00FF00FF, 0x0F0F0F0F0F0F0F0F, 0x3333333333333333, 0x5555555555555555]
    return np.concatenate([np.array(plain, np.uint64), mixed(np.arange(1, max(1, n - len(plain)) + 1, dtype=np.uint64))])[:n]


def distance_table(values: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Row by row the Hamming distances to the references."""
    return np.bitwise_count(values[:, None] ^ references[None, :]).astype(np.int8)


def close_pairs(values: np.ndarray, group: np.ndarray, bits: int, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of one group at most ``bits`` apart, as two arrays of values."""
    if len(values) < 2:
        return values[:0], values[:0]
    distances = distance_table(values, references)
    order = np.lexsort((distances[:, 0], group))
    values, group, distances = values[order], group[order], distances[order]
    left, right, step = [], [], 1
    at = np.arange(len(values) - 1)
    while len(at):
        # sorted by the first distance: once a neighbour is out, all after it are
        at = at[at + step < len(values)]
        at = at[(group[at] == group[at + step]) & (distances[at + step, 0] - distances[at, 0] <= bits)]
        i, j = at, at + step
        for p in range(1, len(references)):
            near = np.abs(distances[i, p] - distances[j, p]) <= bits
            i, j = i[near], j[near]
            if len(i) < 64:
                break
        near = np.bitwise_count(values[i] ^ values[j]) <= bits
        left.append(values[i[near]])
        right.append(values[j[near]])
        step += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (values[:0], values[:0])


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Each linked value with the least of its group."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return [(x, r) for x in list(up) if (r := root(x)) != x]


def linked(values: np.ndarray, group: np.ndarray, free: tuple[int, ...], bits: int, references: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links within groups; ``free`` are the bit positions
    in which members of a group may differ. Groups are sorted."""
    edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    sizes = np.diff(edges)
    out: list[tuple[int, int]] = []
    small = np.repeat((sizes > 1) & (sizes <= SWEPT), sizes)
    out += _forest(*close_pairs(values[small], group[small], bits, references))
    for n in np.flatnonzero(sizes > SWEPT):
        members = values[edges[n] : edges[n + 1]]
        if len(free) <= 3 * (bits + 1):  # few bits left: the sweep is short
            out += _forest(*close_pairs(members, np.zeros(len(members), np.int64), bits, references))
            continue
        for first, length in _blocks(len(free), bits + 1):
            block = free[first : first + length]
            part = _field(members, block)
            order = np.argsort(part, kind="stable")
            out += linked(members[order], part[order], tuple(f for f in free if f not in block), bits, references)
    return out


def _sweep(bits: int, keys: list[tuple[tuple[int, ...], tuple[int, ...]]], n_pivots: int):
    """Links within the buckets of a sorted partition."""

    def flush(key: np.ndarray, fp: np.ndarray, references: np.ndarray) -> list[tuple[int, int]]:
        links: list[tuple[int, int]] = []
        tables = (key % np.int64(len(keys))).astype(np.int64)
        for t in np.unique(tables):
            mine = tables == t
            used = {*keys[t][0], *keys[t][1]}
            links += linked(fp[mine], key[mine], tuple(i for i in range(64) if i not in used), bits, references)
        return _forest(*(np.array([x[i] for x in links], np.uint64) for i in (0, 1))) if links else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        references = pivots(n_pivots)
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if len(key) < CHUNK >> 2:
                continue
            whole = np.searchsorted(key, key[-1])  # the last bucket may go on
            if whole:
                yield from arrow_rows(LINKS, _signed(flush(key[:whole], fp[:whole], references))).to_batches()
                key, fp = key[whole:], fp[whole:]
        if len(key):
            yield from arrow_rows(LINKS, _signed(flush(key, fp, references))).to_batches()

    return run


def _signed(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return [tuple(x - (1 << 64) if x >> 63 else x for x in link) for link in links]


def _keyed(keys: list[tuple[tuple[int, ...], tuple[int, ...]]]):
    """A row for each fingerprint and bucket table: (key, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("key long, fp long")
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for t, (block, part) in enumerate(keys):
                both = _field(fp.view(np.uint64), block + part)
                yield pa.RecordBatch.from_arrays([pa.array(both.astype(np.int64) * len(keys) + t), pa.array(fp)], schema=schema)

    return run


def simhash_links(different: DataFrame, bits: int = 3, n_pivots: int = PIVOTS) -> DataFrame:
    """(a, b): links between the fingerprints of ``different`` (fp), all of them
    up to what connects already linked ones."""
    keys = bucket_keys(bits)
    if any(len(a) + len(b) > 56 for a, b in keys):
        raise ValueError("bits must be 1 or more")
    n = partitions(different.sparkSession)
    return (different.select("fp").mapInArrow(_keyed(keys), "key long, fp long")
            .repartition(n, "key").sortWithinPartitions("key").mapInArrow(_sweep(bits, keys, n_pivots), LINKS))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3,
                  n_pivots: int = PIVOTS) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``; ``fp`` is the
    fingerprint as a signed long."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    made = checkpointed(rows.mapInArrow(_fingerprint_batches(shingle), FINGERPRINTS))
    different = made.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    roots = components(simhash_links(different, bits, n_pivots))
    placed = different.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    per_root = placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members"))
    total = made.count()
    by_root = join_counted(placed.select("fp", "root", "n"), per_root, "root", "members", total)
    by_fp = by_root.select("fp", "component_id", "n")
    return join_counted(made, by_fp, "fp", "n", total).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3) -> DataFrame:
    """``docs`` with the document of the least id of every group. Rows with the
    same id and text are one document; a row without an id cannot be named as
    another's copy and stays."""
    groups = simhash_dedup(docs, id_col, text_col, shingle, bits)
    first = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__first")).distinct()
    kept = docs.filter(F.col(f"`{id_col}`").isNotNull()).join(first, F.col(f"`{id_col}`") == F.col("__first"), "left_semi")
    same = Window.partitionBy(f"`{id_col}`", F.xxhash64(f"`{text_col}`")).orderBy(*[F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)], F.lit(1))
    kept = kept.withColumn("__copy", F.row_number().over(same)).filter("__copy = 1").drop("__copy")
    return kept.unionByName(docs.filter(F.col(f"`{id_col}`").isNull()))
