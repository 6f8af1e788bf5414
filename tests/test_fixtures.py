"""The documents made of the events: dealt over tasks, each made once."""

import datetime

import pytest
from pyspark.sql import functions as F

from callmill.sources import documents, ledger
from checks import fixtures, queries


@pytest.fixture
def sf_dir(spark, tmp_path):
    """An events table in one file, as one row group; keys may repeat or be null."""
    day = datetime.datetime(2024, 1, 1)
    rows = [(i, day + datetime.timedelta(hours=i), i % 7, "click") for i in range(1, 400)]
    rows += [rows[9], (None, day, 1, "signup"), (12, None, None, None)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string")
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_documents_of_one_row_group_are_made_by_all_cores(spark, sf_dir):
    made = fixtures.documents(spark, sf_dir)
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    per_task = made.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 1


def test_more_events_are_dealt_over_more_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fixtures, "EVENTS_A_TASK", 10)
    assert fixtures.documents(spark, sf_dir).rdd.getNumPartitions() == 41


def test_a_filter_does_not_make_the_documents_again(spark, sf_dir):
    kept = fixtures.documents(spark, sf_dir).where(F.col("body").isNotNull())
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("https://book.example/cancel/") == 1


def test_no_event_is_lost_or_repeated(spark, sf_dir):
    made = fixtures.documents(spark, sf_dir)
    found = made.groupBy("event_id", "copy").count().collect()
    assert sum(row["count"] for row in found) == 402 + 40
    twice = {(row.event_id, row["copy"]) for row in found if row["count"] > 1}
    assert twice == {(10, 0), (10, 1), (12, 0)}
    assert made.where("event_id = 97").first().body is None


def test_arrivals_land_compressed_and_read_back_whole(spark, tmp_path):
    bodies = [(f"2024-01-0{1 + i % 3}", f'{{"payload":{{"event":"e{i}","name":"{"First Last " * 20}é"}}}}') for i in range(300)]
    rows = spark.createDataFrame(bodies, "event_date string, body string")
    root = str(tmp_path / "raw")
    for part in (rows, rows.limit(5)):
        queries._arrive(part, root)
    names = [path for path in (tmp_path / "raw").rglob("part-*")]
    assert names and all(path.name.endswith(".txt.gz") for path in names)
    assert sum(path.stat().st_size for path in names) * 4 < sum(len(body) for _, body in bodies)
    read = documents.raw_documents(spark, root, documents.GZIPPED).select("event_date", "body").collect()
    assert sorted(map(tuple, read)) == sorted(bodies + [tuple(row) for row in rows.limit(5).collect()])
    listed = ledger.listing(spark, root, documents.GZIPPED)
    assert listed.count() == len(names)
