"""Substring, suffix-array and SimHash deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from billmodel.llm import registry
from billmodel.llm.common import packed, rolled, sliding_min, unpacked
from billmodel.llm.components import components
from billmodel.llm.simhash_dedup import bucket_keys, close_pairs, linked, one_of_each, pivots, simhash_dedup, simhash_links
from billmodel.llm.substring_dedup import substring_dedup
from billmodel.llm.suffix_dedup import SuffixOrder, suffix_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def odd(spark, rows):
    """Documents with columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, part string, bucket int, docs string")


def removed_words(docs, length):
    """(id, text) rows -> kept words and counts, by the definition."""
    first = {}
    cut = [(i, (t or "").encode().split()) for i, t in docs]
    places = [((2**63 - 1 if i is None else i), p, tuple(w[p : p + length])) for i, w in cut for p in range(len(w) - length + 1)]
    for i, p, g in places:
        first[g] = min(first.get(g, (i, p)), (i, p))
    out = Counter()
    for i, w in cut:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < (2**63 - 1 if i is None else i, p):
                gone[p : p + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out[i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()] += 1
    return out


def test_op3_equals_the_definition(spark, texts):
    got = Counter(map(tuple, registry.op3_substring_dedup(spark, SF).collect()))
    assert got == removed_words(list(texts.items()), 20)


def test_substring_dedup_odd_rows(spark):
    r = random.Random(1)
    words = [r.choice("abcdefgh") for _ in range(60)]
    rows = [(1, None), (2, ""), (3, " ".join(words)), (None, " ".join(words[10:40])), (None, None), (4, " \t ".join(words[5:30])),
            (3, " ".join(words)), (5, "same " * 50), (6, "é " * 30), (-7, " ".join(words[:25])), (8, "long " + "z" * 200_000)]
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(odd(spark, rows), length=8, anchor_words=3).collect())
    assert got == removed_words(rows, 8)
    assert substring_dedup(odd(spark, []), length=8, anchor_words=3).count() == 0
    kept = {r.doc_id: r.kept_text for r in substring_dedup(odd(spark, [(1, "a b c d"), (2, "x a b c d y")]), length=4, anchor_words=2, with_text=True).collect()}
    assert kept == {1: "a b c d", 2: "x y"}


def test_words_that_polynomials_do_not_tell_apart(spark):
    """Two different words of 1024 letters (Thue and Morse's, and its opposite),
    then the same 19 words: nothing repeats."""
    signs = [bin(i).count("1") % 2 for i in range(1024)]
    tail = " ".join(f"w{i}" for i in range(19))
    rows = [(1, "".join("ab"[x] for x in signs) + " " + tail), (2, "".join("ba"[x] for x in signs) + " " + tail), (3, "c " + tail + " " + tail)]
    got = {r.doc_id: r.n_removed for r in substring_dedup(odd(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 0}
    rows[1] = (2, rows[0][1])
    assert {r.doc_id: r.n_removed for r in substring_dedup(odd(spark, rows)).collect()} == {1: 0, 2: 20, 3: 0}


def removed_bytes(docs, length, keep):
    strings, counts = [(i, (t or "").encode()) for i, t in docs], Counter()
    for _, b in strings:
        counts.update(b[p : p + length] for p in range(len(b) - length + 1))
    seen, out = set(), Counter()
    for i, b in sorted(strings, key=lambda x: (x[0] is None, x[0])):
        cover = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            g = b[p : p + length]
            if counts[g] > 1 and (keep == "none" or g in seen):
                cover[p] += 1
                cover[p + length] -= 1
            seen.add(g)
        gone = np.cumsum(cover[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()] += 1
    return out


def test_op9_equals_the_definition(spark, texts):
    got = Counter(map(tuple, registry.op9_suffix_dedup(spark, SF).collect()))
    assert got == removed_bytes(list(texts.items()), 200, "none")


@pytest.mark.parametrize("hot", [50_000, 3, 0])
@pytest.mark.parametrize("keep", ["first", "none"])
def test_suffix_dedup_odd_rows(spark, keep, hot):
    r = random.Random(2)
    text = "".join(r.choice("abé ") for _ in range(300))
    rows = [(1, None), (2, ""), (3, text), (4, "x" + text[20:200] + "y" + text[100:]), (5, "ab" * 90), (-6, text[50:90]), (None, text[:120]), (9, "q" * 100_000)]
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = Counter(tuple(x[c] for c in columns) for x in suffix_dedup(odd(spark, rows), length=24, anchor_bytes=9, keep=keep, hot_segments=hot).collect())
    assert got == removed_bytes(rows, 24, keep)
    assert suffix_dedup(odd(spark, []), length=24, anchor_bytes=9).count() == 0
    twice = suffix_dedup(odd(spark, [(1, text), (1, text)]), length=24, anchor_bytes=9, keep="none", hot_segments=hot).collect()
    assert [x.n_removed for x in twice] == [len(text.encode())] * 2


def test_longest_previous_and_next_factors():
    r = random.Random(3)
    for _ in range(30):
        data = np.array([r.choice(b"ab") for _ in range(r.randint(40, 120))], np.uint8)
        depth = r.choice([8, 11, 24])
        starts = np.arange(len(data) - depth + 1)
        order = SuffixOrder(data, starts, depth)
        raw = data.tobytes()

        def common(i, j):
            n = 0
            while n < depth and max(i, j) + n < len(raw) and raw[i + n] == raw[j + n]:
                n += 1
            return n

        before = [max([common(i, j) for j in range(i)], default=0) for i in starts]
        after = [max([common(i, j) for j in starts[i + 1 :]], default=0) for i in starts]
        assert order.previous_factor().tolist() == before
        assert order.next_factor().tolist() == after


def test_rolling_hash_minimum_and_blobs():
    values = np.random.default_rng(0).integers(0, 2**63, 500).astype(np.uint64)
    for n in (1, 3, 20, 200):
        h = rolled(np.concatenate([values, values]), n)
        assert len(h) == 1001 - n and (h[:10] == h[500:510]).all() and len(set(h[:400].tolist())) == 400
    for w in (1, 2, 7, 500):
        assert sliding_min(values, w).tolist() == [values[i : i + w].min() for i in range(501 - w)]
    for steps in (True, False):
        a, b = unpacked(packed(values, values[::-1], steps=steps), 2, steps)
        assert (a == values).all() and (b == values[::-1]).all()


# --- SimHash ----------------------------------------------------------------------


def fingerprint(text, shingle=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, bits=3):
    """fingerprint -> least member reachable, by all pairs."""
    up = {p: p for p in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= bits:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


def test_op4_equals_the_definition(spark, texts):
    prints = {i: fingerprint(t) for i, t in texts.items()}
    of = groups(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[of[p]] = min(least.get(of[p], i), i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.op4_simhash_dedup(spark, SF).collect()}
    assert got == {i: (f"{p:016x}", least[of[p]]) for i, p in prints.items()}


def planted(seed, clusters, size):
    """Fingerprints that drift a few bits from one another, and lone ones."""
    r, out = random.Random(seed), set()
    for _ in range(clusters):
        at = r.getrandbits(64)
        for _ in range(size):
            out.add(at)
            for _ in range(r.randint(1, 4)):
                at ^= 1 << r.randrange(64)
    return sorted(out | {r.getrandbits(64) for _ in range(50)})


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_links_find_all_pairs(spark, bits):
    """All groups by all pairs of planted fingerprints; large buckets split."""
    prints = planted(bits, 12, 12)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    from billmodel.llm.common import ship_package

    ship_package(spark)
    roots = {r.node: r.root for r in components(simhash_links(df, bits)).collect()}
    want = groups(prints, bits)
    got, expected = {}, {}
    for p, s in zip(prints, signed):
        got.setdefault(roots.get(s, s), set()).add(p)
        expected.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_large_bucket_is_split_not_cut():
    """1500 fingerprints around one value in one bucket: every link is kept."""
    r = random.Random(5)
    values = sorted({r.getrandbits(12) << 20 | r.getrandbits(3) for _ in range(2500)})
    links = linked(np.array(values, np.uint64), np.zeros(len(values), np.int64), tuple(range(28, 64)) + tuple(range(28)), 3, pivots())
    assert len(values) > 1000
    up = {v: v for v in values}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(root(a), root(b))] = min(root(a), root(b))
    assert len({root(v) for v in values}) == len(set(groups(values).values()))


def test_pivot_table_discards_no_link():
    r = random.Random(6)
    values = np.array(planted(9, 6, 20), np.uint64)
    a, b = close_pairs(values, np.zeros(len(values), np.int64), 3, pivots())
    want = {(x, y) for x in values.tolist() for y in values.tolist() if x < y and (x ^ y).bit_count() <= 3}
    assert {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())} == want
    for _ in range(2000):  # linked fingerprints share a bucket
        x = r.getrandbits(64)
        y = x
        for _ in range(r.randint(0, 3)):
            y ^= 1 << r.randrange(64)
        assert any(all((x ^ y) >> i & 1 == 0 for i in block + part) for block, part in bucket_keys(3))


def test_simhash_odd_rows(spark):
    rows = [(5, None), (2, ""), (9, " \n"), (None, "a b c d"), (4, "A b C d"), (3, "one"), (3, "one"), (8, "w " * 60_000), (None, "only without id")]
    got = Counter((r.doc_id, r.fp, r.component_id) for r in simhash_dedup(odd(spark, rows)).collect())
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    f = {t: signed(fingerprint(t)) for _, t in rows}
    assert got == Counter([(5, 0, 2), (2, 0, 2), (9, 0, 2), (None, f["a b c d"], 4), (4, f["a b c d"], 4), (3, f["one"], 3), (3, f["one"], 3),
                           (8, f["w " * 60_000], 8), (None, f["only without id"], None)])
    kept = Counter((r.doc_id, r.text) for r in one_of_each(odd(spark, rows)).collect())
    assert kept == Counter([(2, ""), (4, "A b C d"), (3, "one"), (8, "w " * 60_000), (None, "a b c d"), (None, "only without id")])
    assert simhash_dedup(odd(spark, [])).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 103), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 105: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
