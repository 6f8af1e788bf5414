"""The manifest against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from callmill.llm import merkle, queries
from tests.llm.brute import order

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    parts = (row[0], row[1], row[2], row[3], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def climbed(digests):
    """The last digest, and for every leaf the siblings (left, right) of each level."""
    at, paths, level = list(range(len(digests))), [[] for _ in digests], digests
    while len(level) > 1:
        for k, a in enumerate(at):
            start = a // 8 * 8
            paths[k].append(("".join(level[start:a]), "".join(level[a + 1 : start + 8])))
        at = [a // 8 for a in at]
        level = [digest("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], paths


def plain(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((order(row[0]), leaf(row, row[4]), row))
    langs = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {}
    for lang in langs:
        trees[lang].sort(key=lambda x: x[:2])
        built[lang] = climbed([x[1] for x in trees[lang]])
    if not langs:
        return []
    root, upper = climbed([built[lang][0] for lang in langs])
    out = []
    for lang, above in zip(langs, upper):
        subroot, paths = built[lang]
        for (_, own, row), path in zip(trees[lang], paths):
            now, text = own, row[4]
            if zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 3 == 0 and text is not None:
                now = leaf(row, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
            proof = ""
            for left, right in path + above:
                now, proof = digest(left + now + right), proof + left + right
            out.append((row[0], own, subroot, root, digest(proof), now, now == root))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some(n, langs, seed):
    r = random.Random(seed)
    word = lambda: r.choice(["Alpha", "beta", "ÄÖ", "x\n", "", "\x00", "İ"])
    return [(i, word(), r.choice(langs), len(word()), " ".join(word() for _ in range(5))) for i in range(n)]


@pytest.mark.parametrize("n, langs", [(0, ["a"]), (1, ["a"]), (1, [None]), (8, ["a"]), (9, ["a"]), (65, ["a"]), (600, ["a", "b", "", None, "é", "z:1"])])
def test_manifest_equals_plain_tree(spark, n, langs):
    rows = some(n, langs, n)
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert rows_of(got) == plain(rows)


def test_many_languages(spark):
    """More subroots than one node holds, and lone leaves among them."""
    rows = some(200, [f"l{k}" for k in range(90)], 3)
    assert rows_of(merkle.manifest(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_edges(spark):
    """Nulls everywhere, repeated rows, one id with two texts, a long text, and clashing extra columns."""
    text = "Long TEXT " * 60_000
    rows = [(None,) * 5, (None,) * 5, (None, None, None, None, "A"), (-3, "s", "en", 1, text), (7, None, None, None, "")]
    rows += [(5, "s", "en", 2, "Same Row")] * 40 + [(5, "s", "en", 2, "Another")]
    names = ("tree", "digest", "now", "idx", "n", "part", "key", "members", "run", "parent", "_row", "leaf", "a.b")
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit(1) for name in names}).repartition(4)
    assert rows_of(merkle.manifest(docs)) == plain(rows)


def test_a_repeated_row_spreads(spark):
    """Rows that are one row many times are numbered apart, and by more than one task."""
    docs = spark.createDataFrame([(5, "s", "en", 2, "Same")] * 500, SCHEMA).repartition(4)
    placed = merkle.numbered(merkle.leaves(docs), ["doc_id", "digest"]).collect()
    assert sorted(r.idx for r in placed) == list(range(500)) and {r.n for r in placed} == {500}


def test_small_levels_lie_in_few_files(spark, monkeypatch):
    """Many shuffle partitions do not make a file each of the few nodes of a level."""
    written, real = [], merkle.saved

    def spied(df, label):
        out = real(df, label)
        written.append((label, len(out.inputFiles())))
        return out

    monkeypatch.setattr(merkle, "saved", spied)
    rows = some(600, ["a", "b", None], 3)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        assert rows_of(merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(4))) == plain(rows)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # The documents' own rows are written where they are read.
    assert len(written) > 8 and {n for label, n in written if label != "merkle-rows"} == {1}


def test_tampering_shows(spark):
    got = queries.op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    changed = {r.doc_id for r in texts if zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in r.text or "")}
    assert {r.doc_id for r in got if not r.verified} == changed != set()
    assert len({r.root for r in got}) == 1
