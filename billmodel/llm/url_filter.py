"""URL rules as a sort-merge range join.

A rule is a host and a path prefix; it fits a URL whose host is that host or a
subdomain of it and whose path starts with the prefix. Of the rules that fit,
the longest (host and path together; of equals the one with the longer host, of
the same rule given twice ``block``) decides; where none fits the verdict is
``default``.

A host with its labels reversed, each closed by a separator below all other
characters, is a key under which a host and all its subdomains are one interval:
the keys that start with the host's own. URLs and rules meet in buckets of key
ranges. The ranges are cut at quantiles of a bounded sample of keys, with a hash
of the row as a tie-break, so a host or URL with a third of all rows is spread
over several buckets; a rule is sent to every bucket that its interval touches.
(The sample only balances the buckets; any cuts give the same result.) In its
bucket everything is sorted by key and swept once: a stack holds the nested
rules whose intervals are open, a row closes those it has left, a rule opens its
own, and a URL tests the path prefixes of the open ones.

Nulls and odd rows: a null URL, or one without ``://``, has an empty host and
path; a rule with an empty or null host fits every host, one with an empty or
null path every path; a rule whose verdict is null is no rule. Null ids and
repeated rows are kept as they are; extra columns are ignored; no rules give
``default`` everywhere; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billmodel.llm.common import arrow_rows, partitions, ship_package

RESULT = "page_id long, host string, path string, rule string, verdict string"
MOVED = "bucket int, key string, kind int, page_id long, host string, path string, rule string, verdict string"
#: Keys sampled per bucket to place the cuts, and at most in all.
SAMPLED, MOST_SAMPLED = 50, 200_000
CLOSE = "\x01"
RULE, PAGE = 0, 1
ROWS = 20_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from right to left, each closed by the separator."""
    labels = F.transform(F.reverse(F.split(host, r"\.")), lambda x: F.concat(x, F.lit(CLOSE)))
    return F.when(host == "", F.lit("")).otherwise(F.array_join(labels, ""))


def _send(cuts: list[tuple[str, int]]):
    """The bucket of a URL, and all buckets of a rule's interval."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, tie, kind, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == PAGE:
                    out.append((bisect_right(cuts, (key, tie)), key, kind, *rest))
                else:
                    first = bisect_right(cuts, (key, -(1 << 63)))
                    last = bisect_right(cuts, (key + "\U0010ffff", 0)) if key else len(cuts)
                    out += [(b, key, kind, *rest) for b in range(first, last + 1)]
                if len(out) >= ROWS:
                    yield from arrow_rows(MOVED, out).to_batches()
                    out = []
            yield from arrow_rows(MOVED, out).to_batches()

    return run


class _Open:
    """The rules of one host whose interval is open."""

    def __init__(self, key: str, host: str):
        self.key, self.host = key, host
        self.by_path: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []

    def add(self, path: str, rule: str, verdict: str) -> None:
        if path not in self.by_path:
            self.lengths = sorted({*self.lengths, len(path)}, reverse=True)
        elif verdict != "block":
            return
        self.by_path[path] = rule, verdict

    def fits(self, path: str) -> tuple[int, tuple[str, str]] | None:
        for n in self.lengths:
            if n <= len(path) and (found := self.by_path.get(path[:n])):
                return n, found
        return None


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, stack = None, []
        for batch in batches:
            out = []
            for b, key, kind, page_id, host, path, rule, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket:
                    bucket, stack = b, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == RULE:
                    if not stack or stack[-1].key != key:
                        stack.append(_Open(key, host))
                    stack[-1].add(path, rule, verdict)
                    continue
                best = None
                for open_ in stack:
                    if open_.host and host != open_.host and not host.endswith("." + open_.host):
                        continue  # a label that holds the separator
                    if (fit := open_.fits(path)) and (best is None or len(open_.host) + fit[0] >= best[0]):
                        best = len(open_.host) + fit[0], fit[1]
                out.append((page_id, host, path, *(best[1] if best else (None, default))))
            yield from arrow_rows(RESULT, out).to_batches()

    return run


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``; ``rules``
    has the columns host, path and verdict (``allow`` or ``block``). ``rule`` is
    the deciding rule's host and path written together."""
    spark = pages.sparkSession
    ship_package(spark)
    n = partitions(spark)
    url = F.col(f"`{url_col}`").cast("string")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    cut = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                       F.xxhash64(F.col(f"`{id_col}`").cast("long"), url).alias("tie"))
    rows = cut.select(F.concat(host_key(F.col("host")), F.when(F.col("host") != "", F.lit("\x00")).otherwise(F.lit("")), "path").alias("key"),
                      "tie", F.lit(PAGE).alias("kind"), "page_id", "host", "path",
                      F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    known = rules.filter(F.col("verdict").isNotNull()).select(F.translate(text("host"), UPPER, LOWER).alias("host"), text("path").alias("path"), "verdict")
    known = known.select(host_key(F.col("host")).alias("key"), F.lit(0).cast("long").alias("tie"), F.lit(RULE).alias("kind"),
                         F.lit(None).cast("long").alias("page_id"), "host", "path", F.concat("host", "path").alias("rule"), "verdict")
    share = min(1.0, min(SAMPLED * n, MOST_SAMPLED) / max(1, pages.count()))
    seen = sorted((r.key, r.tie) for r in rows.select("key", "tie").sample(share, seed=1).collect())
    cuts = sorted({seen[len(seen) * i // n] for i in range(1, n)}) if seen else []
    moved = rows.unionByName(known).mapInArrow(_send(cuts), MOVED)
    return (moved.repartitionById(len(cuts) + 1, "bucket").sortWithinPartitions("bucket", "key", "kind")
            .mapInArrow(_sweep(default), RESULT))
