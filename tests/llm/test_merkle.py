"""Merkle manifest against a plain computation."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from billmodel.llm import registry
from billmodel.llm.merkle_manifest import merkle_manifest

VALUES = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row: tuple) -> str:
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(levels: list[list[str]], at: int) -> list[tuple[str, str | None]]:
    out = []
    for row in levels[:-1]:
        other = at ^ 1
        out.append(("L" if other < at else "R", row[other]) if other < len(row) else ("N", None))
        at //= 2
    return out


def manifest(rows: list[tuple]) -> Counter:
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    langs = sorted(by_lang, key=lambda x: b"" if x is None else b"+" + x.encode())
    trees = {lang: tree([leaf for _, _, leaf, _ in sorted(by_lang[lang], key=lambda x: x[:3])]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    out = Counter()
    for n, lang in enumerate(langs):
        for at, (_, _, leaf, row) in enumerate(sorted(by_lang[lang], key=lambda x: x[:3])):
            steps = path(trees[lang], at) + path(top, n)
            i, source, lang_, n_chars, text = row
            tampered = i is not None and n_chars is not None and crc32(str(i).encode()) % 7 == 0
            h = leaf_of((i, source, lang_, n_chars + 1, text)) if tampered else leaf
            for side, other in steps:
                h = digest(h) if side == "N" else digest(other, h) if side == "L" else digest(h, other)
            root = top[-1][0]
            out[i, leaf, trees[lang][-1][0], root, digest(*(o for _, o in steps if o)), h, h == root] += 1
    return out


def tampering():
    n = F.col("n_chars")
    more = (n.cast("decimal(20,0)") + 1).cast("string")
    return {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, more).otherwise(n.cast("string"))}


def columns(df):
    return Counter(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()))


def test_op11_equals_the_definition(spark):
    rows = [tuple(r[c] for c in VALUES) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = Counter(map(tuple, registry.op11_merkle_manifest(spark, "/root/testdata/sf0.001").collect()))
    assert got == manifest(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_odd_rows_and_small_superblocks(spark, levels):
    r = random.Random(5)
    langs = [None, "", "en", "en", "en", "de", "é", "\U0001f600", "-", "+"]
    rows = [(r.choice([None, *range(-20, 60)]), r.choice([None, "", "web"]), r.choice(langs), r.choice([None, 0, 7, 2**63 - 1]),
             r.choice([None, "", "x", "ä€\U0001f600", "long " * 40_000])) for _ in range(90)]
    rows += rows[:7]
    docs = spark.createDataFrame([(*x, "a", 1, 2, b"z") for x in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, `hash` int, found binary")
    assert columns(merkle_manifest(docs, found=tampering(), levels=levels)) == manifest(rows)


def test_empty_one_row_and_proof_steps(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle_manifest(spark.createDataFrame([], schema)).count() == 0
    one = (4, "s", "en", 3, "abc")
    (got,) = merkle_manifest(spark.createDataFrame([one], schema), with_proof=True).collect()
    assert got.leaf == got.subroot == got.root == got.folded_root == leaf_of(one) and got.proof == "" and got.proof_sha256 == digest()
    three = [(i, "s", "en", 3, "abc") for i in range(3)]
    got = {r.doc_id: r.proof for r in merkle_manifest(spark.createDataFrame(three, schema), with_proof=True).collect()}
    a, b, c = map(leaf_of, three)
    assert got == {0: "R" + b + "R" + digest(c), 1: "L" + a + "R" + digest(c), 2: "NL" + digest(a, b)}


def test_a_group_of_many_superblocks(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "id AS n_chars", "cast(id AS string) AS text")
    rows = [(i, "s", "en", i, str(i)) for i in range(3000)]
    assert columns(merkle_manifest(docs, found=tampering(), levels=4)) == manifest(rows)
