"""Language identification by Bayesian evidence fusion.

Four kinds of evidence on a document's language are fused in log space:

* *text*: byte-trigram likelihoods of the whole text, one table of trigram
  probabilities per language, for every label that has rows, fitted on a bounded
  sample of them (about ``SAMPLE_ROWS`` different texts a language, picked by a
  hash over all rows, counted where they are). Trigrams are not independent, so
  a text weighs as much as ``EVIDENCE`` trigrams at most. The tables take 256 KB
  a language, on the driver and in every worker.
* *declared* language (of the markup, or a column), right with ``DECLARED``;
* *address suffix* (a country domain or a path), right with ``SUFFIX``;
* *host prior*: how the texts of a host are spread over languages, by grouped
  sums of the text posteriors of all rows, smoothed towards the host's parent
  domain, that towards the top domain, and that towards all rows.

``und`` (no language) competes with a uniform trigram model. A document is kept
if a language other than ``und`` has a posterior of at least ``least``.

Two scans of the texts: one for the grouped sums, one for the verdicts; texts
are not shuffled while the hosts fit a broadcast of ``MOST_HOSTS`` rows (checked
by a count), else rows are joined on the host, hot hosts apart.

Nulls and odd rows: a null or empty text has no text evidence and is ``und``,
not kept; missing or unknown declared languages and suffixes are no evidence; a
null host has the prior of all rows; repeated rows get the same verdict; a table
without labelled rows, or an empty one, knows no language: all rows are ``und``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billmodel.llm.common import CHUNK, checkpointed, join_counted, let, ship_package

#: Different labelled texts a language that the trigram tables are fitted on (expected).
SAMPLE_ROWS = 300
#: Numbers (trigrams times languages) that are looked up at once.
CELLS = 1 << 24
EVIDENCE, DECLARED, SUFFIX, UNKNOWN = 60, 0.9, 0.8, 0.01
#: Rows of the parent's spread that a level of the host hierarchy starts from.
SMOOTHING = 20.0
MOST_HOSTS = 100_000
BUCKETS = 1 << 16
UND = "und"


def _trigrams(data: np.ndarray) -> np.ndarray:
    d = data.astype(np.uint32)
    code = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(16)


@dataclass
class TrigramModel:
    languages: list[str]  # und is the last
    logs: np.ndarray  # trigram bucket x language

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Text by text the log likelihoods and the number of trigrams."""
        sizes = np.maximum(np.array([len(t) for t in texts], np.int64) - 2, 0)
        out = np.zeros((len(texts), len(self.languages)))
        some = np.flatnonzero(sizes)
        if len(some):
            codes = _trigrams(np.frombuffer(b"".join(texts[i] for i in some), np.uint8))
            starts = np.concatenate([[0], np.cumsum(sizes[some][:-1] + 2)])
            ends = starts + sizes[some]
            step = max(1, CELLS // len(self.languages))
            for at in range(0, len(codes), step):
                logs = self.logs[codes[at : at + step]]
                # the texts that this slice has trigrams of, the ends of it cut
                a, b = np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + len(logs), "left")
                if a == b:
                    continue
                cuts = np.stack([np.maximum(starts[a:b] - at, 0), np.minimum(ends[a:b] - at, len(logs))], axis=1).ravel()
                if cuts[-1] == len(logs):
                    cuts = cuts[:-1]
                out[some[a:b]] += np.add.reduceat(logs, cuts, axis=0, dtype=np.float64)[::2]
        return out, sizes


def _counted(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode(), np.uint8)
    return np.bincount(_trigrams(data), minlength=BUCKETS) if len(data) > 2 else np.zeros(BUCKETS, np.int64)


def _tables(languages: list[str], counts: Iterable[np.ndarray]) -> TrigramModel:
    """The model of each language's counts by bucket, add-half smoothed."""
    logs = np.full((BUCKETS, len(languages) + 1), -np.log(BUCKETS), np.float32)  # und is uniform
    for n, found in enumerate(counts):
        logs[:, n] = np.log((found + 0.5) / (found + 0.5).sum())
    return TrigramModel([*languages, UND], logs)


def fit(samples: list[tuple[str, str]], languages: list[str]) -> TrigramModel:
    """Trigram tables of (language, text) rows."""
    nothing = np.zeros(BUCKETS, np.int64)
    return _tables(languages, (sum((_counted(t) for lang, t in samples if lang == language), nothing) for language in languages))


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, bucket, n) of (label, text), summed by batch."""
    for batch in batches:
        found: dict[str, np.ndarray] = {}
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if label not in found:
                found[label] = np.zeros(BUCKETS, np.int64)
            found[label] += _counted(text.as_py())
            if len(found) == 64:
                yield from _count_rows(found)
                found = {}
        yield from _count_rows(found)


def _count_rows(found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for label, counts in found.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())],
                                         ["label", "bucket", "n"])


def _text_evidence(model: TrigramModel) -> Callable[[Column], Column]:
    """Tempered log likelihoods of a text column; null without trigrams."""
    def run(column: pa.Array) -> pa.Array:
        out, texts, held = [], [], 0

        def flush() -> None:
            logs, n = model.scores(texts)
            weight = np.minimum(n, EVIDENCE) / np.maximum(n, 1)
            out.extend(row if k else None for row, k in zip((logs * weight[:, None]).tolist(), n.tolist()))

        for t in column.cast(pa.large_binary()):
            texts.append((t.as_py() or b"").lower())
            held += len(texts[-1])
            if held >= CHUNK:
                flush()
                texts, held = [], 0
        flush()
        return pa.array(out, pa.list_(pa.float64()))

    # not to be worked out once more for a filter on what follows from it
    return F.arrow_udf(run, "array<double>").asNondeterministic()


def _softmax(logs: Column) -> Column:
    """Probabilities of an array of log weights."""
    powers = let(F.array_max(logs), lambda most: F.transform(logs, lambda x: F.exp(x - most)))
    return let(powers, lambda e: let(F.aggregate(e, F.lit(0.0), lambda x, y: x + y), lambda total: F.transform(e, lambda x: x / total)))


def _constants(values: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _claim(claimed: Column, model: TrigramModel, right: float) -> Column:
    """Log probability of a claimed language under each language; zeros where
    nothing (known) is claimed."""
    known = model.languages[:-1]
    wrong = max((1 - right) / max(1, len(known) - 1), 1e-9)
    nothing = _constants([0.0] * len(model.languages))
    if not known:
        return nothing
    # one row of numbers, not one a language: the claimed place alone differs
    place = F.try_element_at(F.create_map(*[F.lit(x) for n, c in enumerate(known) for x in (c, n)]), F.coalesce(claimed, F.lit("")))
    others = _constants([*[float(np.log(wrong))] * len(known), float(np.log(1 / len(known)))])
    under = let(place, lambda at: F.when(at.isNotNull(), F.transform(others, lambda x, n: F.when(n == at, float(np.log(right))).otherwise(x))))
    return F.coalesce(under, nothing)


def host_levels(host: Column) -> list[Column]:
    """Top domain, parent domain and host of a host name."""
    labels = F.split(host, r"\.")
    parent = F.when(F.size(labels) > 2, F.array_join(F.slice(labels, 2, F.size(labels) - 1), ".")).otherwise(host)
    return [F.element_at(labels, -1), parent, host]


def host_priors(spread: DataFrame, n_languages: int) -> tuple[DataFrame, int, list[float], int]:
    """(host, host_rows, prior): smoothed spreads by host, the number of hosts,
    the spread of all rows, and how many rows there are. ``spread`` has host and
    p0, p1, ...; it is read once, into a written table of one row a host."""
    sums = [F.sum(f"p{i}").alias(f"p{i}") for i in range(n_languages)]
    every = checkpointed(spread.groupBy("host").agg(F.count("*").alias("host_rows"), *sums))
    top, parent, _ = host_levels(F.col("host"))
    hosts = every.filter(F.col("host").isNotNull()).withColumn("top", top).withColumn("parent", parent)
    total = every.agg(F.sum("host_rows").alias("n"), F.count("host").alias("hosts"), *sums).first()
    n_rows, n_hosts = total["n"] or 0, total["hosts"]
    everything = [((total[f"p{i}"] or 0.0) + 1.0 / n_languages) / (n_rows + 1.0) for i in range(n_languages)]

    def smoothed(rows: Column, above: list[Column], prefix: str) -> Column:
        return F.array(*[(F.col(f"{prefix}{i}") + SMOOTHING * above[i]) / (rows + SMOOTHING) for i in range(n_languages)])

    def level(key: str, above: str | None) -> DataFrame:
        keys = [key] if above is None else [key, above]
        return hosts.groupBy(*keys).agg(F.sum("host_rows").alias("rows"), F.count("*").alias("below"), *sums)

    tops = level("top", None)
    tops = tops.select("top", "below", smoothed(F.col("rows"), [F.lit(x) for x in everything], "p").alias("above"))
    parents = level("parent", "top")
    above = lambda: [F.col("above")[i] for i in range(n_languages)]
    parents = join_counted(parents.withColumnRenamed("below", "hosts"), tops, "top", "below", n_hosts)
    parents = parents.select("parent", F.col("hosts").alias("below"), smoothed(F.col("rows"), above(), "p").alias("above"))
    hosts = join_counted(hosts, parents, "parent", "below", n_hosts)
    return hosts.select("host", "host_rows", smoothed(F.col("host_rows"), above(), "p").alias("prior")), n_hosts, everything, n_rows


def train(docs: DataFrame, text: Column, label: Column, sample_rows: int = SAMPLE_ROWS) -> TrigramModel:
    """Trigram tables of every label, from about ``sample_rows`` different texts each."""
    ship_package(docs.sparkSession)
    rows = docs.select(label.alias("label"), text.alias("text")).filter("text <> '' and label <> ''")
    # copies of one text share a spot: a share of the different texts, else a label of copies may have none
    known = rows.groupBy("label").agg(F.approx_count_distinct(F.xxhash64("text")).alias("texts")).collect()
    languages = sorted(r["label"] for r in known)
    if not languages:
        return fit([], [])
    share = F.create_map(*[F.lit(x) for r in known for x in (r["label"], min(1.0, sample_rows / r["texts"]))])
    spot = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / 1_000_003.0
    picked = rows.filter(spot < F.element_at(share, F.col("label"))).distinct()
    sums = picked.mapInArrow(_bucket_counts, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    place = F.element_at(F.create_map(*[F.lit(x) for n, c in enumerate(languages) for x in (c, n)]), F.col("label"))
    found = sums.select(place.alias("place"), F.col("bucket").cast("int").alias("bucket"), "n").toArrow()
    places, buckets, n = (found.column(c).to_numpy() for c in ("place", "bucket", "n"))
    order = np.argsort(places, kind="stable")
    ends = np.searchsorted(places[order], np.arange(len(languages) + 1))

    def counts() -> Iterator[np.ndarray]:
        for a, b in zip(ends, ends[1:]):
            yield np.bincount(buckets[order[a:b]], n[order[a:b]], BUCKETS)

    return _tables(languages, counts())


def language_id(docs: DataFrame, text: Column, declared: Column | None = None, suffix: Column | None = None, host: Column | None = None,
                label: Column | None = None, least: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with language, confidence and kept. ``label`` (by default the
    declared language) marks the rows to fit on."""
    spark = docs.sparkSession
    ship_package(spark)
    none = F.lit(None).cast("string")
    text, declared, suffix, host = (none if c is None else c.cast("string") for c in (text, declared, suffix, host))
    model = train(docs, text, declared if label is None else label.cast("string"), sample_rows)
    n = len(model.languages)
    prior = [*[1.0 / n] * (n - 1), UNKNOWN]
    # internal columns have a prefix of their own; results replace columns of their names
    own, key = [c for c in docs.columns if c not in ("language", "confidence", "kept")], "__lang_host"
    scored = docs.select(*[F.col(f"`{c}`") for c in own], _text_evidence(model)(text).alias("__lang_logs"), declared.alias("__lang_declared"),
                         suffix.alias("__lang_suffix"), host.alias(key))
    text_only = _softmax(_added(F.col("__lang_logs"), _constants(np.log(prior))))
    seen = scored.filter(F.col("__lang_logs").isNotNull()).select(F.col(key).alias("host"), text_only.alias("post"))
    spread = seen.select("host", *[F.col("post")[i].alias(f"p{i}") for i in range(n)])
    hosts, n_hosts, everything, total = host_priors(spread, n)
    hosts = hosts.select(F.col("host").alias(key), "host_rows", F.col("prior").alias("__lang_prior"))
    if n_hosts <= MOST_HOSTS:
        joined = scored.join(F.broadcast(hosts.drop("host_rows")), key, "left")
    else:
        joined = join_counted(scored, hosts.withColumnRenamed("host_rows", "__lang_rows"), key, "__lang_rows", total)
    priors = F.transform(F.coalesce("__lang_prior", _constants(everything)), lambda x: F.log(x))
    claims = _added(_claim(F.col("__lang_declared"), model, DECLARED), _claim(F.col("__lang_suffix"), model, SUFFIX))
    fused = joined.withColumn("__lang_fused", F.when(F.col("__lang_logs").isNotNull(), _added(_added(F.col("__lang_logs"), priors), claims)))
    posterior = fused.withColumn("__lang_post", F.when(F.col("__lang_fused").isNotNull(), _softmax(F.col("__lang_fused"))))
    best = posterior.withColumn("confidence", F.coalesce(F.array_max("__lang_post"), F.lit(0.0)))
    at = F.array_position("__lang_post", F.col("confidence")).cast("int")
    named = best.withColumn("language", F.coalesce(F.element_at(F.array(*[F.lit(x) for x in model.languages]), F.nullif(at, F.lit(0))), F.lit(UND)))
    kept = (F.col("language") != UND) & (F.col("confidence") >= least)
    return named.withColumn("kept", kept).select(*[F.col(f"`{c}`") for c in own], "language", "confidence", "kept")


def documents_language(docs: DataFrame) -> DataFrame:
    """The corpus table: the language column is the declared one, the source is
    the host, and there are no addresses."""
    return language_id(docs, F.col("text"), declared=F.col("lang"), host=F.col("source"))


def pages_language(pages: DataFrame) -> DataFrame:
    """Raw pages: text without tags, the markup's lang attribute, the address's
    language path or country domain, and the host hierarchy."""
    from billmodel.llm.url_filter import host_of, path_of

    html, url = F.col("html"), F.col("url")
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    declared = F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang=[\"']?([a-z]+)", 1)), F.lit(""))
    path = F.lower(F.regexp_extract(path_of(url), r"^/([A-Za-z]{2})(/|$)", 1))
    domain = F.regexp_extract(host_of(url), r"\.([a-z]{2})$", 1)
    suffix = F.coalesce(F.nullif(path, F.lit("")), F.nullif(domain, F.lit("")))
    return language_id(pages, text, declared=declared, suffix=suffix, host=F.nullif(host_of(url), F.lit("")))
