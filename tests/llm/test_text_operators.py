"""URL filter, personal data, decontamination, language, language model,
quality rules and byte-level BPE against brute force; the pipeline as a whole."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from billmodel.llm import pii as P
from billmodel.llm import registry
from billmodel.llm.byte_bpe import Encoder, byte_bpe, merge_alone, merge_together
from billmodel.llm.common import join_counted
from billmodel.llm.decontamination import Sketches, decontamination, plain, without_leaks
from billmodel.llm.language_id import fit, host_priors, language_id
from billmodel.llm.lm_score import lm_score
from billmodel.llm.pii_model import KINDS, Tagger, spans_of
from billmodel.llm.quality_rules import Rule, cascade, ordered, quality_rules, text_rules
from billmodel.llm.url_filter import url_filter

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CLASHING = ", part string, bucket int, key string, host string, prior string"


def odd(spark, rows):
    """Documents with columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, t, "x", 1, "k", "h", "p") for i, t in rows], "doc_id long, text string" + CLASHING)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def same_as_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    result = con.execute(registry.oracle_sql()[name])
    columns = sorted(c[0] for c in result.description)
    assert sorted(df.columns) == columns
    want = Counter(map(tuple, con.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()))
    assert Counter(map(tuple, df.select(*columns).collect())) == want and want


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_statement(spark, name):
    same_as_duckdb(spark, name)


# --- URL filter ---------------------------------------------------------------------


def judged(url, rules, default):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


def test_url_filter_against_every_rule(spark):
    r = random.Random(4)
    labels, paths = ["a", "b", "com", "A", "", "x\x01y", "é"], ["/", "/a", "/a/b", "/ab", ""]
    rules = sorted({(".".join(r.choices(labels[:3] + labels[6:], k=r.randint(1, 3))), r.choice(paths), r.choice(["allow", "block"])) for _ in range(40)} | {("", "/a/b", "block")})
    urls = [f"{r.choice(['http', 'x://y', ''])}{r.choice(['://', ':', '://'])}{'.'.join(r.choices(labels, k=r.randint(1, 4)))}{r.choice(paths)}{r.choice(['', '?q=/a', '#f', '/b?x#y'])}"
            for _ in range(500)] + [None, "", "://", "http://COM", "http://com/a\nb"] + ["http://hot.com/a/b"] * 200
    pages = spark.createDataFrame([(i if i % 50 else None, u, "k", "h") for i, u in enumerate(urls)], "page_id long, url string, key string, host string")
    table = spark.createDataFrame([(h, p, v, 1) for h, p, v in rules] + [("a", "/", None, 1)], "host string, path string, verdict string, kind int")
    got = Counter(map(tuple, url_filter(pages, table, default="block").collect()))
    assert got == Counter((i if i % 50 else None, *judged(u, rules, "block")) for i, u in enumerate(urls))
    assert url_filter(pages.limit(0), table).count() == 0
    assert {x.verdict for x in url_filter(pages, table.limit(0)).collect()} == {"allow"}


def test_op1_judges_by_the_rules_of_its_contract(spark, tmp_path):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    urls = [f"http://{host}{path}" for host in ("org", "example.org", "a.EXAMPLE.org", "com", "b.com", "net")
            for path in ("", "/", "/es/", "/es", "/en/", "/en/1", "/en/12?x", "/fr/a", "/de/", "/de#f")]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    want = Counter((i, *judged(u, rules, "allow")) for i, u in enumerate(urls))
    columns = ["page_id", "host", "path", "rule", "verdict"]
    assert Counter(map(tuple, registry.op1_url_filter(spark, str(tmp_path)).select(*columns).collect())) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert Counter(map(tuple, con.execute(f"SELECT {', '.join(columns)} FROM ({registry.OP1_SQL})").fetchall())) == want


# --- personal data -------------------------------------------------------------------


def base_by_definition(text):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and P.luhn(d)]
    return out + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_the_patterns(documents):
    r = random.Random(2)
    texts = ["".join(r.choice("a@.1 2-+_(@.b9.") for _ in range(r.randint(0, 30))) for _ in range(20_000)]
    for text in texts + [t for _, t in documents] + ["4111111111111111 x", "1" * 5000, "a." * 3000 + "@", "000000000000000000000001.2.3.4",
                                                         "0" * 4200 + ".1.1.1"]:
        assert P.base_spans(text) == base_by_definition(text)


def test_base_spans_of_long_numbers():
    """Parts beyond the digits that an integer may be read from."""
    for zeros in (4301, 100_000):
        text = "0" * zeros + "7.1.1.1 and 1.2.3." + "0" * zeros + "256"
        assert P.base_spans(text) == [(1, 0, zeros + 7)]


def test_op2_keeps_the_base(spark, documents):
    rows = {r.doc_id: r for r in registry.op2_pii(spark, SF).collect()}
    assert len(rows) == len(documents)
    for i, text in documents:
        base = P.spelled(base_by_definition(text))
        assert rows[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(rows[i].spans.split(","))
        assert rows[i].n_email == base.count("email:") and rows[i].n_phone == base.count("phone:")


def test_tagger_gradients_and_decoding():
    model = Tagger(3)
    for name in ("inputs", "recur", "out", "bias", "moves"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    rng = np.random.default_rng(1)
    chars, tags = rng.integers(0, 20, (3, 8)), np.zeros((3, 8), np.int64)
    tags[0, 2], tags[0, 3:5], tags[2, 7] = 1, 2, 7
    _, grads = model.step(chars, tags)
    for p, g in zip(model.parameters, grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, side = p[at], []
        for d in (1e-5, -1e-5):
            p[at] = old + d
            side.append(model.step(chars, tags)[0])
        p[at] = old
        assert abs((side[0] - side[1]) / 2e-5 - g[at]) < 1e-4
    # Viterbi equals the best of all paths
    import itertools

    from billmodel.llm.pii_model import allowed

    scores = rng.normal(0, 1, (4, len(model.bias))).astype(np.float32)
    moves = model.moves + allowed()
    value = lambda p: allowed()[0, p[0]] + sum(scores[t, x] for t, x in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))
    best = max(itertools.product(range(len(model.bias)), repeat=4), key=value)
    assert model.decode([scores, scores[:2]])[0].tolist() == list(best)
    assert spans_of(np.array([0, 1, 2, 2, 0, 3, 3, 4])) == [(0, 1, 4), (1, 5, 6), (1, 6, 8)]


def test_long_stretches_take_no_grid_of_all(spark):
    """One stretch of a table page among hundreds of short ones: decoded as if
    alone, in memory that follows the sum of lengths."""
    import tracemalloc

    model, rng = Tagger(), np.random.default_rng(5)
    scores = [rng.normal(0, 1, (n, len(model.bias))).astype(np.float32) for n in [*rng.integers(1, 90, 511), 20_000]]
    model.moves = rng.normal(0, 1, model.moves.shape).astype(np.float32)
    tracemalloc.start()
    got = model.decode(scores)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # a grid of all: 370 MB
    for n in [*range(0, 511, 50), 511]:
        assert got[n].tolist() == model.decode([scores[n]])[0].tolist()
    texts = ["1,2;" * 5000, "call +1 555 123 4567 now", "x"]
    assert P.model_spans(model, texts) == [P.model_spans(model, [t])[0] for t in texts]


def test_model_finds_held_out_spans(spark):
    """Trained on one half of the documents, it finds the other half's spans."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("length(text) < 5000")
    model = P.train(docs.filter("doc_id % 2 = 0"))
    found = total = 0
    for r in docs.filter("doc_id % 2 = 1 and text rlike '[0-9@]'").limit(400).collect():
        if want := set(P.base_spans(r.text)):
            total += len(want)
            found += len(want & set(P.model_spans(model, [r.text])[0]))
    assert total > 150 and found >= 0.9 * total
    number = "call 456-555-2186 ext, card 3782 822463 10005 now"  # no plus; 15 digits that pass Luhn
    (base, every), = P.find_spans([number], model)
    assert base == [] and all(P.well_formed(k, number[s:e]) for k, s, e in every)


def test_model_adds_what_the_patterns_miss(spark):
    """Spellings beyond the patterns, in documents that were not trained on."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held_out = docs.filter("doc_id in (1377, 7052)").collect()
    model = P.train(docs.filter("doc_id not in (1377, 7052)"))
    for row in held_out:  # a phone number that the pattern runs beyond, into an address
        (base, every), = P.find_spans([row.text], model)
        assert [row.text[s:e] for k, s, e in every if k == P.PHONE and (k, s, e) not in base] == [{1377: "+1 (826) 555-4081", 7052: "+1 (843) 555-7672"}[row.doc_id]]
    r = random.Random(3)
    number = lambda sep="-": f"{r.randint(200, 999)}{sep}{r.randint(200, 999)}{sep}{r.randint(1000, 9999)}"
    address = lambda: ".".join(str(r.randint(1, 255)) for _ in range(4))
    words = "der die and the of to in la les que el los thing reand".split()
    say = lambda n: " ".join(r.choices(words, k=n))
    forms = {"no plus": lambda: (number(), ""), "dots": lambda: ("+1." + number("."), ""), "an address follows": lambda: (f"+1 {number()}", " " + address()),
             "in parentheses": lambda: (f"+1 ({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}", " " + address()),
             "a card follows": lambda: (f"+1 {number()}", " 4111 1111 1111 1111")}
    for form, make in forms.items():
        found = 0
        for _ in range(100):
            phone, more = make()
            front = say(8) + " "
            (_, every), = P.find_spans([f"{front}{phone}{more} {say(8)}"], model)
            found += (P.PHONE, len(front), len(front) + len(phone)) in every
        assert found >= 90, (form, found)
    clean = [f"{say(5)} {r.randint(0, 10 ** 6)} {say(4)} {r.random():.3f} {say(3)} 2024-0{r.randint(1, 9)}" for _ in range(200)]
    assert sum(len(every) for _, every in P.find_spans(clean, model)) <= 2


def test_windows_are_reconciled_as_defined(spark):
    """Averages of overlapping windows' scores and one best path, worked out plainly."""
    model, r = Tagger(4, seed=9), random.Random(6)
    model.moves = np.random.default_rng(2).normal(0, 1, model.moves.shape).astype(np.float32)
    model.out *= 8
    texts = ["".join(r.choice("ab1@. +2") for _ in range(n)) for n in (5, 64, 65, 150, 333)]
    taken = [[], [(P.IP, 10, 17)], [], [(P.CARD, 0, 20), (P.IP, 15, 30)], [(P.PHONE, 300, 333)]]
    for blocked in (None, taken):
        for d, text in enumerate(texts):
            want = []
            for s, e in P.stretches(text):
                sums, weights = np.zeros((e - s, len(model.bias))), np.zeros(e - s)
                last = max(0, e - s - P.WINDOW)
                for at in sorted({*range(0, max(1, last), P.STRIDE), last}):
                    row = np.full((1, P.WINDOW), P.CLASSES)
                    piece = P.classes(text[s + at : min(e, s + at + P.WINDOW)])
                    row[0, : len(piece)] = piece
                    scores = model.emissions(row)[0]
                    for i in range(len(piece)):
                        weight = min(i + 1, P.WINDOW - i)
                        sums[at + i] += weight * scores[i]
                        weights[at + i] += weight
                scores = (sums / weights[:, None]).astype(np.float32)
                for _, a, b in blocked[d] if blocked else []:
                    for i in range(max(a, s), min(b, e)):
                        scores[i - s, 1:] = -1e4
                want += [(k, s + a, s + b) for k, a, b in spans_of(model.decode([scores])[0])]
            assert P.model_spans(model, [text], None if blocked is None else [blocked[d]])[0] == want


def test_model_learns_among_harmless_digits(spark):
    """Tables of harmless numbers with nearly all windows, and a sample with few
    of the labelled rows: the model still finds what the patterns miss."""
    r = random.Random(12)
    number = lambda: f"{r.randint(200, 999)}-{r.randint(200, 999)}-{r.randint(1000, 9999)}"
    say = lambda x: f"{r.choice(['please call', 'my phone is', 'reach us at'])} {x} {r.choice(['now', 'any time', 'for more'])}"
    rows = [" ".join(f"row {r.randint(1, 10**6)} has {r.random():.4f};" for _ in range(40)) for _ in range(2000)]
    rows += [say(f"+1 {number()}") for _ in range(150)] + [say(f"a{i}b@example{i}.org") for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    windows = P.training_windows(docs, "text", 30)
    kinds = Counter(max(t) // 2 if any(t) else 0 for _, t in windows)
    assert kinds[4] >= 120 and kinds[1] >= 70 and kinds[0] > 3 * kinds[4]
    fresh = [say(number()) for _ in range(50)]
    found = P.find_spans(fresh, P.train(docs, train_docs=30))
    assert all(base == [] for base, _ in found)
    assert sum(any(k == P.PHONE for k, _, _ in every) for _, every in found) >= 45
    # parts and their order make no difference
    assert P.training_windows(docs.orderBy(F.desc("doc_id")).coalesce(1), "text", 30) == windows


def test_pii_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a@b.co"), (3, "x " * 50_000 + "1.2.3.4"), (4, "ü 4111 1111 1111 1111"), (4, "ü 4111 1111 1111 1111"), (5, "1" * 30_000)]
    got = P.pii(odd(spark, rows), with_masked=True).collect()
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == Counter(
        [(1, 0, 0, 0, 0), (2, 0, 0, 0, 0), (None, 1, 0, 0, 0), (3, 0, 1, 0, 0), (4, 0, 0, 1, 0), (4, 0, 0, 1, 0), (5, 0, 0, 0, 0)])
    assert {r.masked for r in got if r.doc_id in (None, 4)} == {"<email>", "ü <card>"}
    masked = P.mask_texts(odd(spark, rows))
    assert masked.columns == odd(spark, rows).columns
    assert {r.text for r in masked.collect() if r.doc_id in (1, 4)} == {None, "ü <card>"}
    assert P.pii(odd(spark, [])).count() == 0
    assert P.masked("abcdef", [(0, 1, 4), (2, 3, 5)]) == "a<email>f"


# --- decontamination ------------------------------------------------------------------


def contained(item: str | None, text: str | None, size: int = 5) -> tuple[int, int]:
    """Different shingles of an item, and how many of them are in the text; an
    item of fewer words is one shingle of that length."""
    cut = lambda x: [w for w in "".join(c if c.isalnum() else " " for c in (x or "").lower()).split(" ") if w]
    wanted, words = cut(item), cut(text)
    size = min(size, len(wanted))
    grams = lambda ws: {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)} if size else set()
    return len(grams(wanted)), len(grams(wanted) & grams(words))


def test_typographic_marks_do_not_hide_a_leak():
    items = Sketches([(1, 'the "quick" brown fox - jumps over'), (2, "Ça va ? Oui : très bien"), (3, "中文 字")], 5, 0.8)
    texts = ["x the \u201cquick\u201d brown\u00a0fox \u2014 jumps over y", "ça va\u00a0? oui\u202f: très bien", "a 中文，字。"]
    assert [(d, i) for d, i, *_ in items.leaks([plain(t) for t in texts])] == [(0, 1), (1, 2), (2, 3)]


def test_sketches_find_every_leak(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(words, k=r.choice([1, 3, 5, 8, 20, 40])))) for i in range(25)] + [(None, None), (90, ""), (7, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for i in range(60):
        text = r.choices(words, k=r.randint(0, 300))
        _, item = r.choice(items[:25])
        part = item.split()
        if r.random() < 0.7:
            for _ in range(r.choice([0, 0, 1, 2])):
                part[r.randrange(len(part))] = "other"
            text[r.randint(0, len(text)) : 0] = part
        docs.append((i, " ".join(w.upper() if r.random() < 0.1 else w for w in text).replace(" w1 ", ", w1. ")))
    docs += [(None, items[3][1]), (200, None), (201, ""), (202, "w1 " * 30_000)]
    want = Counter()
    for i, t in docs:
        for q, s in items:
            n, shared = contained(s, t)
            if n and shared >= 0.8 * n - 1e-9:
                want[i, q, n, shared] += 1
    table = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((x.doc_id, x.item_id, x.n_shingles, x.n_shared) for x in decontamination(odd(spark, docs), table).collect())
    assert got == want and want
    clean = Counter((x.doc_id, x.text) for x in without_leaks(odd(spark, docs), table).collect())
    leaked = {k[0] for k in want}
    assert {i for i, _ in clean} == {i for i, _ in docs if i not in leaked}
    assert decontamination(odd(spark, docs), table.limit(0)).count() == 0
    assert decontamination(odd(spark, []), table).count() == 0
    assert Sketches([(1, "a b c d e f g")], 5, 0.8).needed(10) == 8


# --- language --------------------------------------------------------------------------


def test_language_of_held_out_texts(spark):
    """Fitted on labelled rows, the text alone names the language of others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hidden = docs.withColumn("known", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    out = language_id(hidden, F.col("text"), label=F.col("known")).filter("known is null and length(text) > 40")
    right, n = out.agg(F.avg((F.col("lang") == F.col("language")).cast("int")), F.count("*")).first()
    assert n > 300 and right > 0.97


def test_evidence_decides_where_the_text_cannot(spark):
    train = [(i, "the cat and the dog " * 5, "en", "a.example.org") for i in range(40)] + [(100 + i, "le chat et le chien " * 5, "fr", "b.example.fr") for i in range(40)]
    rows = [(500, "zzzz", "fr", None), (501, "zzzz", None, "b.example.fr"), (502, "zzzz", None, "new.example.fr"), (503, None, "fr", None), (504, "", None, None),
            (505, "the dog and the cat " * 3, "fr", None), (None, "le chat", None, None)]
    df = spark.createDataFrame(train + rows, "doc_id long, text string, lang string, host string")
    out = {r.doc_id: r for r in language_id(df, F.col("text"), declared=F.col("lang"), host=F.col("host")).collect()}
    assert out[505].language == "en"  # a long text outweighs its label
    assert out[500].confidence >= 0 and out[503].language == "und" and not out[503].kept and not out[504].kept
    assert out[None].language == "fr"
    spread = spark.createDataFrame([("a.x.fr", 0.1, 0.9)] * 30 + [("b.x.fr", 0.9, 0.1)] + [(None, 0.5, 0.5)], "host string, p0 double, p1 double")
    priors, n_hosts, everything, n = host_priors(spread, 2)
    got = {r.host: r.prior for r in priors.collect()}
    assert (n_hosts, n) == (2, 32) and abs(sum(everything) - 1) < 1e-9
    assert all(abs(sum(p) - 1) < 1e-9 for p in got.values())
    assert got["a.x.fr"][1] > got["b.x.fr"][1] > 0.5  # one row does not outweigh the domain


def test_every_label_is_a_language(spark, monkeypatch):
    """A hundred labels, the rare ones of one text and many copies of it."""
    r = random.Random(6)
    words = [["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(20)] for _ in range(100)]
    rows = []
    for n, own in enumerate(words):
        text = " ".join(r.choices(own, k=40))
        rows += [(" ".join(r.choices(own, k=40)), f"l{n:02}") for _ in range(8)] if n < 70 else [(text, f"l{n:02}")] * (900 if n == 99 else 2)
    df = spark.createDataFrame(rows + [(" ".join(r.choices(own, k=40)), None) for own in words], "text string, lang string")
    got = Counter((x.lang, x.language, x.kept) for x in language_id(df, F.col("text"), declared=F.col("lang"), sample_rows=30).collect())
    assert got == Counter((lang, lang, True) for _, lang in rows) + Counter((None, f"l{n:02}", True) for n in range(100))
    # scored in slices: the same numbers
    model = fit(rows[:40], sorted({lang for _, lang in rows[:40]}))
    texts = [t.encode() for t, _ in rows[:9]] + [b"", b"ab", b"abcd", b"abc"]
    whole = model.scores(texts)
    for cells in (1, 7, 200, 1000):
        monkeypatch.setattr("billmodel.llm.language_id.CELLS", cells)
        assert all(np.allclose(a, b, rtol=1e-12) for a, b in zip(model.scores(texts), whole))


def test_language_odd_tables(spark):
    nothing = language_id(odd(spark, [(1, "abc def"), (2, None)]), F.col("text"))
    assert {(r.language, r.kept) for r in nothing.collect()} == {("und", False)}
    assert nothing.columns[:7] == odd(spark, []).columns
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert registry.documents_language(empty).count() == 0
    scores, n = fit([("x", "abcabc")], ["x"]).scores([b"", b"ab", b"abc", b"abcabc", b"", b"zz"])
    assert n.tolist() == [0, 0, 1, 4, 0, 0] and (scores[[0, 1, 4, 5]] == 0).all()
    assert np.allclose(scores[3], fit([("x", "abcabc")], ["x"]).scores([b"abcabc"])[0][0])


def test_hot_keys_join_by_broadcast(spark):
    left = spark.range(5000).select((F.col("id") % 7).alias("g"), "id").withColumn("k", F.when(F.col("g") < 5, F.lit("hot")).when(F.col("g") == 5, F.col("id").cast("string")))
    right = left.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("v"))
    got = Counter((r.id, r.v) for r in join_counted(left, right, "k", "n", 5000, plain_rows=0).collect())
    assert got == Counter((r.id, r.v) for r in left.join(right, "k", "left").collect())


# --- language model -----------------------------------------------------------------------


def scores(docs, order, backoff=0.4):
    cut = [(i, (t or "").encode().split()) for i, t in docs]
    grams = lambda w: Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    every = sum((grams(w) for _, w in cut), Counter())
    words, out = sum(len(w) for _, w in cut), []
    for i, w in cut:
        own, total = grams(w), 0.0
        rest = max(words - len(w), 1)
        for e in range(len(w)):
            for n in range(min(order, e + 1), 0, -1):
                g = tuple(w[e - n + 1 : e + 1])
                if c := every[g] - own[g]:
                    below = every[g[:-1]] - own[g[:-1]] if n > 1 else rest
                    total += math.log(c / below) + (order - n) * math.log(backoff)
                    break
            else:
                total += math.log(0.5 / rest) + (order - 1) * math.log(backoff)
        out.append((i, len(w), total))
    return out


def test_op7_equals_brute_force(spark, documents):
    want = {i: (n, s) for i, n, s in scores(documents, 3)}
    for r in registry.op7_lm_score(spark, SF).collect():
        assert r.n_words == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-4


@pytest.mark.parametrize("order", [1, 2, 4])
def test_lm_odd_rows(spark, order):
    r = random.Random(order)
    rows = [(i, " ".join(r.choices("abcde", k=r.randint(0, 30)))) for i in range(20)] + [(50, None), (None, "a b c"), (51, "a b c"), (51, "a b c"), (52, "z" * 50_000)]
    got = Counter((x.doc_id, x.n_words, round(x.score, 3)) for x in lm_score(odd(spark, rows), order=order).collect())
    assert got == Counter((i, n, round(s, 3)) for i, n, s in scores(rows, order))
    assert lm_score(odd(spark, []), order=order).count() == 0


# --- quality rules ------------------------------------------------------------------------


def measures(text):
    text = text or ""
    w = [x for x in re.split("[ \t-\r]+", text) if x]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often, cover = Counter(windows), set()
    for i, g in enumerate(windows):
        if often[g] > 1:
            cover |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


def test_quality_odd_rows(spark):
    r = random.Random(9)
    rows = [(i, "".join(r.choice(["a ", "b ", "c ", "\n", "# ", "é", "\x0b"]) for _ in range(r.randint(0, 120)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "x y z"), (102, "same line here\n" * 30), (102, "same line here\n" * 30), (103, "w " * 20_000), (104, "\u00a0 a\u2028b c")]
    out = quality_rules(odd(spark, rows), with_measures=True).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((x.doc_id, *(x[n] for n in names)) for x in out) == Counter((i, *measures(t)) for i, t in rows)
    bare = Counter((x.doc_id, x.kept) for x in quality_rules(odd(spark, rows)).collect())
    assert bare == Counter((x.doc_id, x.kept) for x in out)  # measured columns or not: one verdict
    assert quality_rules(odd(spark, [])).count() == 0


def test_cascade_order_and_short_circuit(spark):
    df = spark.range(200).withColumn("text", F.lit("a b c"))
    slow = F.length(F.repeat(F.col("text"), 20_000)) < 0
    rules = [Rule("slow", slow), Rule("never", F.col("id") < 0), Rule("half", F.col("id") % 2 == 0)]
    assert ordered(df, rules)[0].name == "half"
    assert ordered(df.limit(0), rules) == rules
    # a rule behind one that rejects everything is not evaluated
    trap = F.raise_error(F.lit("evaluated")).cast("boolean")
    assert df.select(cascade([Rule("all", F.lit(True) & (F.col("id") >= 0)), Rule("trap", trap)]).alias("by")).distinct().collect()[0].by == "all"
    assert len({r.name for r in text_rules()}) == len(text_rules())


def test_quality_runs_no_python(spark):
    plan = registry.op8_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- byte-level BPE --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    own = Encoder(RANKS, public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.vocabulary.ranks, special_tokens={})


def test_bpe_equals_tiktoken(bpe, documents):
    own, other = bpe
    r = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "é", "中", "'s", "9", "\t", "\x1c", "\u00a0", "\u3000", "!", "xyz", " \n", "ß", "🙂", "<|endoftext|>"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(1500)] + ["a" * 5000, "ab" * 700 + " x", "", " ", "   ", "x  ", "中" * 3000] + [t for _, t in documents]
    for i in range(0, len(texts), 64):
        for text, ids in zip(texts[i : i + 64], own.texts(texts[i : i + 64])):
            assert ids == other.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_bpe_words_kept_in_two_generations(bpe, monkeypatch):
    """Few kept words, met again and again: the same ids."""
    from billmodel.llm import byte_bpe as B

    _, other = bpe
    monkeypatch.setattr(B, "KEPT_WORDS", 20)
    own, r = Encoder(RANKS, public_tokenizers.PATTERN), random.Random(4)
    words = [f"wo{i}rd{'x' * (i % 60)}" for i in range(90)]
    for _ in range(40):
        texts = [" ".join(r.choices(words, k=12)) for _ in range(3)]
        assert own.texts(texts) == [other.encode_ordinary(t) for t in texts]
        assert len(own.words) <= 20 + 36 and len(own.older) <= 20 + 36


def test_segment_trees_agree(bpe):
    own, _ = bpe
    r = random.Random(3)
    pieces = sorted({"".join(r.choices("theandionsé中", k=r.randint(2, 30))).encode()[:32] for _ in range(300)} - {b""})
    pieces = [p for p in pieces if len(p) > 1]
    assert merge_together(pieces, 32, own.vocabulary) == [merge_alone(p, own.vocabulary) for p in pieces]


def test_bpe_odd_rows(spark, bpe):
    _, other = bpe
    rows = [(1, None), (2, ""), (None, "a b"), (3, "same"), (3, "same"), (4, "x" * 200_000), (5, "word " * 40_000)]
    got = byte_bpe(odd(spark, rows), RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    want = Counter()
    for i, t in rows:
        ids = other.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert byte_bpe(odd(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


# --- pipeline -----------------------------------------------------------------------------------


def test_pipeline_stages_and_result(spark, documents, tmp_path):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == columns
    known = {r.doc_id: r for r in registry.op6_language_id(spark, SF).collect()}
    assert {r.doc_id for r in kept["language"]} == {i for i, r in known.items() if r.kept}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaky = lambda t: any((n := contained(s, t))[1] >= 0.8 * n[0] for _, s in items)
    assert {r.doc_id for r in kept["benchmark"]} == {r.doc_id for r in kept["near_copies"] if not leaky(r.text)}
    assert [r.doc_id for r in kept["personal_data"] if P.base_spans(r.text)] == []
    assert all(r.n_chars == len(r.text) for r in kept["personal_data"])
    e = Encoder(RANKS, public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in kept["personal_data"]}
    want = Counter((i, len(ids := e.texts([t])[0]), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts.items())
    assert Counter(map(tuple, kept["tokens"])) == want
    assert Counter(map(tuple, registry.pipeline(spark, SF).collect())) == want


def test_pipeline_of_odd_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "the cat a@b.co and the dog " * 9, "en", "s", 1), (3, "the cat a@b.co and the dog " * 9, "en", "s", 1),
            (None, "le chat et le chien " * 9, "fr", "s", 1)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert Counter(r.doc_id for r in docs.collect()) == (Counter([3, None]) if some else Counter())
    assert KINDS == ("email", "ip", "card", "phone")
