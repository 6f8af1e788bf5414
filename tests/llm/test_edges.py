"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from callmill.llm import (
    decontam,
    license_scan,
    line_chunks,
    line_quality,
    merkle,
    order_minhash,
    packing,
    passage_quality,
    sharding,
    suffix_dedup,
    token_count,
    toxicity,
)
from tests.llm.brute import order

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
R = random.Random(7)
PROSE = " ".join("".join(R.choice("abcdefgh") for _ in range(R.randint(2, 8))) for _ in range(60))
LONG = "\n".join(" ".join(f"w{R.randrange(5000)}" for _ in range(12)) for _ in range(6000))  # some 450 KB

ROWS = [
    (None, None, None, None, None),
    (None, PROSE, None, None, 1),
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t\n ", None, "a", 5),
    (4, PROSE, "en", None, 3),
    (4, PROSE, "en", None, 3),  # a repeated row
    (4, PROSE + " more", "en", None, 3),  # an id with another text
    (5, PROSE, "en", "b", 3),  # a copy
    (6, "x", "en", "b", 1),
    (7, "a" * 3000, "en", "b", 3000),
    (8, LONG, "en", "b", len(LONG)),
    (9, LONG.replace("w1 ", "w2 "), "en", "b", len(LONG)),
    (10, "café \U0001f600\x00 İstanbul" * 9, "fr", "b", 9),
]
CLASHING = (
    "size", "shard", "slot", "part", "h", "k", "n", "piece", "start", "until", "_row", "_text", "_v", "_key",
    "_text_hash", "_host", "_lines", "ranges", "score", "length", "a.b", "toxic", "line",
)
BENCHMARK = [("i1", " ".join(PROSE.split()[5:25])), (None, "x"), ("i2", None), ("i2", ""), ("i3", "no such words here")]


def clashing(df):
    return df.withColumns({name: F.lit(1) for name in CLASHING})


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(ROWS, SCHEMA)).repartition(5)


@pytest.fixture(scope="module")
def benchmark(spark):
    return clashing(spark.createDataFrame(BENCHMARK, "item_id string, text string"))


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(None, 1, 1), (4, 1, None), (5, 0, 1), (5, 0, 0), (7, 1, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: (order(r[0]), repr(r[1:])))


OPERATORS = {
    "op1": lambda d, b, t: suffix_dedup.suffix_dedup(d),
    "op2": lambda d, b, t: line_chunks.line_dedup(d),
    "op3": lambda d, b, t: packing.pack_documents(d),
    "op4": lambda d, b, t: decontam.contamination(d, b),
    "op5": lambda d, b, t: line_quality.line_verdicts(d),
    "op6": lambda d, b, t: license_scan.scan(d),
    "op7": lambda d, b, t: toxicity.score(d, toxicity.train(d, t)),
    "op8": lambda d, b, t: sharding.shard_by_bytes(d, 4),
    "op9": lambda d, b, t: order_minhash.near_duplicates(d),
    "op10": lambda d, b, t: token_count.count_tokens(d),
    "op11": lambda d, b, t: passage_quality.score(d, passage_quality.train(d, t)),
    "op12": lambda d, b, t: merkle.manifest(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_row(spark, docs, benchmark, labels, name):
    got = OPERATORS[name](docs, benchmark, labels)
    ids = sorted((r.doc_id for r in got.filter("piece = 0" if name == "op3" else "true").collect()), key=order)
    expected = sorted((r[0] for r in ROWS), key=order)
    assert ids == expected


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, docs, benchmark, labels, name):
    none = lambda df: df.filter("false")
    assert OPERATORS[name](none(docs), benchmark, labels).count() == 0
    if name in ("op4", "op7", "op11"):
        assert OPERATORS[name](docs, none(benchmark), none(labels)).count() == len(ROWS)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, benchmark, tmp_path, name, stage):
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = stage(spark, docs, str(tmp_path))
    if name == corpus_pipeline.STAGES[-1][0]:
        assert got.filter("piece = 0").count() == len(ROWS)
    else:
        assert got.columns == docs.columns and got.schema == docs.schema
    assert stage(spark, docs.filter("false"), str(tmp_path)).count() == 0


def test_defined_results(spark, docs, benchmark, labels):
    """Null and empty texts."""
    got = {name: OPERATORS[name](docs, benchmark, labels).filter("doc_id IN (1, 2)") for name in OPERATORS}
    assert rows_of(got["op1"], "doc_id", "n_bytes", "n_removed", "n_spans") == [(1, 0, 0, 0), (2, 0, 0, 0)]
    assert rows_of(got["op2"], "doc_id", "n_removed_lines") == [(1, 0), (2, 0)]
    assert rows_of(got["op3"], "doc_id", "piece", "length") == [(1, 0, 1), (2, 0, 1)]
    assert rows_of(got["op4"], "doc_id", "n_words", "n_hit", "contaminated") == [(1, 0, 0, False), (2, 0, 0, False)]
    assert rows_of(got["op5"], "doc_id", "n_words", "base_failed", "kept") == [(1, 0, True, False), (2, 0, True, False)]
    assert rows_of(got["op6"], "doc_id", "licenses", "n_licenses") == [(1, "", 0), (2, "", 0)]
    assert len({r.score for r in got["op7"].collect()}) == 1
    assert rows_of(got["op8"], "doc_id", "size", "text_crc32") == [(1, 1, 0), (2, 1, 0)]
    # The least id among null and empty texts is the null one.
    assert rows_of(got["op9"], "doc_id", "class_id") == [(1, None), (2, None)]
    assert rows_of(got["op10"], "doc_id", "n_bytes", "n_tokens") == [(1, 0, 0), (2, 0, 0)]
    assert len({r.score for r in got["op11"].collect()}) == 1
    assert [r[0] for r in rows_of(got["op12"], "doc_id")] == [1, 2]


def test_one_of_each_keeps_one_row(spark, docs):
    kept = order_minhash.one_of_each(docs)
    assert kept.filter(F.col("text") == PROSE).count() == 1
    assert kept.filter("text IS NULL OR text = ''").count() == 1
