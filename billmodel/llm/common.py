"""Helpers that several operators share: session set-up, text buffers, rolling
hashes, and compact blobs for arrays that travel through a shuffle."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from billmodel.session import checkpoint_dir

#: White space of every word definition here, as a regular-expression class.
BLANK = r"\x20\x09-\x0D"
#: Bytes of text handled at once by the vectorised parts of a task.
CHUNK = 1 << 20

MASK = (1 << 64) - 1


#: Rows of a batch between Spark and Python. Texts are long: Spark's 10,000 rows
#: would hold tens to hundreds of MB in each task, on both sides.
BATCH_SETTING, BATCH_ROWS, SPARKS_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000", "10000"


def ship_package(spark: SparkSession) -> None:
    """Readies a session for jobs in Python: sends this package to the executors
    once per application, so that their workers can import the functions that
    the jobs name (the archive is the driver's own, Spark sends its content),
    and lowers the rows of a batch unless they were set otherwise."""
    if spark.conf.get(BATCH_SETTING) == SPARKS_BATCH:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    sc = spark.sparkContext
    if getattr(sc, "_billmodel_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="billmodel-py-"), "billmodel_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(target)
    sc._billmodel_shipped = True


def partitions(spark: SparkSession) -> int:
    """The number of parts a corpus is dealt into: the session's shuffle
    partitions, which a cluster sizes to its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def optional(df: DataFrame, name: str, kind: str) -> Column:
    """A column of ``df`` cast to ``kind``, or a typed null where it is missing."""
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use).getItem(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
          "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a plain column list such as ``"id long, body binary"``."""
    return pa.schema([pa.field(name, _ARROW[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def arrow_rows(schema: str, rows: list[tuple]) -> pa.Table:
    """Row tuples as an Arrow table of ``schema``."""
    s = arrow_schema(schema)
    columns = zip(*rows) if rows else [[] for _ in s]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, s)], schema=s)


# --- arrays -------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random 64-bit value per byte, and odd bases of the polynomial hashes.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
WORD_BASE = 0x9FB21C651E98DF25
GRAM_BASE = 0xD6E8FEB86659FD93
#: Longer words are hashed as a whole.
POLYNOMIAL_BYTES = 64
_powers: dict[str, np.ndarray] = {}


def powers(base: int, n: int, kind: str) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per worker."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, CHUNK + (CHUNK >> 2))
        out = np.ones(size, np.uint64)
        out[1:] = np.uint64(base)
        _powers[kind] = have = np.multiply.accumulate(out)
    return have[:n]


def rolled(values: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of ``n`` consecutive values (by doubling)."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out, width, at, size = None, 0, values, 1
    while True:
        if n & size:
            if out is None:
                out, width = at, size
            else:  # at: a block of `size` in front of what there is
                m = len(values) - (size + width) + 1
                out = at[:m] * np.uint64(pow(GRAM_BASE, width, 1 << 64)) + out[size : size + m]
                width += size
        size *= 2
        if size > n:
            return mixed(out)
        m = len(values) - size + 1
        at = at[:m] * np.uint64(pow(GRAM_BASE, size // 2, 1 << 64)) + at[size // 2 : size // 2 + m]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values (two running minima per block)."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = -len(x) % w
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    front = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], front[w - 1 : w - 1 + n])


def is_in(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of ``x`` are among the sorted values ``ordered``."""
    if not len(ordered) or not len(x):
        return np.zeros(len(x), bool)
    at = np.searchsorted(ordered, x)
    at[at == len(ordered)] = 0
    return ordered[at] == x


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


class Words:
    """Words of several texts in one buffer: ``hashes`` one 64-bit hash a word,
    ``doc`` the text that each word is of, ``start``/``end`` its bytes."""

    def __init__(self, texts: list[bytes], separators: np.ndarray = _SPACE):
        joined = b"\n".join(texts)
        data = np.frombuffer(joined, np.uint8)
        space = np.ones(len(data) + 2, bool)
        space[1:-1] = separators[data]
        change = np.flatnonzero(space[1:] != space[:-1])
        self.start, self.end = change[0::2], change[1::2]
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        self.doc = np.searchsorted(ends, self.start, side="right")
        if len(self.start):
            power = powers(WORD_BASE, len(data), "word")
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(BYTE_VALUES[data] * power, out=sums[1:])
            undo = powers(pow(WORD_BASE, -1, 1 << 64), len(data), "unword")
            self.hashes = mixed((sums[self.end] - sums[self.start]) * undo[self.start])
            # polynomials modulo 2**64 meet on long texts of a certain build
            for i in np.flatnonzero(self.end - self.start > POLYNOMIAL_BYTES).tolist():
                self.hashes[i] = xxh3_64_intdigest(joined[self.start[i] : self.end[i]])
        else:
            self.hashes = np.zeros(0, np.uint64)
        self.data = data


# --- blobs ----------------------------------------------------------------------


def packed(*arrays: np.ndarray, steps: bool = True) -> bytes:
    """Arrays of one length as one compressed blob, by byte planes. ``steps``
    stores differences of neighbours: good for sorted or slowly growing values."""
    planes = []
    for a in arrays:
        a = np.ascontiguousarray(a).astype(np.uint64, copy=False)
        if steps:
            a = np.concatenate([a[:1], a[1:] - a[:-1]])
        planes.append(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(blob: bytes, count: int = 1, steps: bool = True) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(data) // (8 * count)
    out = []
    for i in range(count):
        planes = data[i * 8 * n : (i + 1) * 8 * n].reshape(8, n)
        values = np.ascontiguousarray(planes.T).view(np.uint64).ravel()
        out.append(np.cumsum(values, dtype=np.uint64) if steps else values)
    return out


def dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The positions of ``keys`` by bucket, in their order."""
    if not len(keys):
        return
    b = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], b[order][1:] != b[order][:-1]]))
    for s, e in zip(at, np.concatenate([at[1:], [len(order)]])):
        yield int(b[order[s]]), order[s:e]


# --- documents dealt into parts ---------------------------------------------------

PART_SCHEMA = "part int, docs binary"
#: A null id stands behind all others.
NULL_ID = np.iinfo(np.int64).max


#: Bytes of documents that a task deals at once (larger blobs press better).
DEALT = 16 << 20


def _deal_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= DEALT:
            yield from _deal(held)
            held = []
    yield from _deal(held)


def _deal(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, press = arrow_schema(PART_SCHEMA), zstandard.ZstdCompressor(level=1)
    part = np.concatenate([np.zeros(0, np.int32), *(b.column(0).to_numpy(zero_copy_only=False) for b in batches)])
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1]]))
    whole = pa.Table.from_batches(batches).drop_columns(["part"])
    parts, blobs = [], []
    for s, e in zip(at, np.concatenate([at[1:], [len(order)]])):
        sink = pa.BufferOutputStream()
        rows = whole.take(pa.array(order[s:e])).combine_chunks()
        with pa.ipc.new_stream(sink, rows.schema) as w:
            w.write_table(rows)
        parts.append(int(part[order[s]]))
        blobs.append(press.compress(sink.getvalue()))
    for s in range(0, len(parts), 64):
        yield pa.RecordBatch.from_arrays([pa.array(parts[s : s + 64], pa.int32()), pa.array(blobs[s : s + 64], pa.binary())], schema=schema)


def deal_documents(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(part, docs): documents by a hash of id and text, compressed by part. The
    passes of an operator group it by ``part``; its exchange is shared by them."""
    ship_package(docs.sparkSession)
    doc_id, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.pmod(F.xxhash64(doc_id, text), F.lit(parts)).cast("int").alias("part"),
                       doc_id.alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(_deal_batches, PART_SCHEMA)


def part_documents(blobs: pa.ChunkedArray, size: int = CHUNK) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Ids and UTF-8 texts of a part, about ``size`` bytes at a time."""
    ids: list[int | None] = []
    texts: list[bytes] = []
    held = 0
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob.as_buffer())
        for batch in pa.ipc.open_stream(raw):
            col = batch.column("text").cast(pa.large_binary())
            for i, t in zip(batch.column("doc_id"), col):
                t = t.as_py()
                ids.append(i.as_py())
                texts.append(t)
                held += len(t)
                if held >= size:
                    yield ids, texts
                    ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def id_array(ids: list[int | None]) -> np.ndarray:
    return np.array([NULL_ID if i is None else i for i in ids], dtype=np.int64)


def ordered_ids(ids: np.ndarray) -> np.ndarray:
    """Signed ids as unsigned values in the same order."""
    return ids.astype(np.uint64) ^ np.uint64(1 << 63)


# --- joins ------------------------------------------------------------------------

#: A key is hot if it holds more than this share of the rows, so at most
#: 1 / HOT_SHARE keys are hot: a proven bound for their broadcast.
HOT_SHARE = 0.001
#: Up to so many rows in all no key can hold more than one task joins at ease.
PLAIN_ROWS = 100_000


def join_counted(left: DataFrame, right: DataFrame, key: str, count: str, total: int, plain_rows: int = PLAIN_ROWS) -> DataFrame:
    """Left join to ``right`` (one row per non-null ``key``, with the ``count`` of
    left rows of the key, ``total`` in all). Rows of hot keys find theirs in a
    broadcast of at most ``1 / HOT_SHARE`` rows and stay where they are; only
    the others are shuffled. With at most ``plain_rows`` rows in all it is a
    plain join. ``count`` is dropped."""
    if total <= plain_rows:
        return left.join(right.drop(count), key, "left")
    hot = right.filter(F.col(count) > total * HOT_SHARE)
    rest = right.filter(F.col(count) <= total * HOT_SHARE).drop(count)
    known = F.broadcast(hot.select(F.col(key).alias("__hot")))
    marked = left.join(known, F.col(key) == F.col("__hot"), "left")
    few = marked.filter(F.col("__hot").isNull()).drop("__hot").join(rest, key, "left")
    many = marked.filter(F.col("__hot").isNotNull()).drop("__hot").join(F.broadcast(hot.drop(count)), key)
    return few.unionByName(many)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder in ``spark.checkpoint.dir`` that all executors
    share (one of its own where the setting is missing, as in tests)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
