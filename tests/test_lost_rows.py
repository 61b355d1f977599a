"""Rows that must not be lost, and rows that must not get in."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from pvspark.operators import jobs, sinks
from pvspark.session import ensure_checkpoint_dir, remove_path
from pvspark.streaming import ingest

REPORT = ("report_id string, drug_name string, reaction string, severity string, age string, weight string, report_date string, "
          "hospitalization string, death string, disability string")


def _lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-{len(os.listdir(path)):03d}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def _message(i, when="2024-01-01T00:00:00+00:00"):
    return json.dumps({"post_id": str(i), "subreddit": "s", "title": "t", "body": "b", "score": 1, "created_utc": when})


def test_bronze_rerun_with_fewer_months_and_malformed_lines(spark, tmp_dir):
    rows = [("1", "A", "r", "1", "30", "70", "20240105", None, "0", "0"), ("2", "B", "r", "2", "40", "70", "20240210", None, "0", "0")]
    path = sinks.write_batch(spark.createDataFrame(rows, REPORT), f"{tmp_dir}/raw", "faers", "2024-03-01")
    assert sinks.bronze_load(spark, path, f"{tmp_dir}/t", "faers_events", "2024-03-01").count() == 2
    again = f"{tmp_dir}/again"
    _lines(again, ['{"report_id":"1","report_date":"20240105"}', "not json", '{"report_id":'])
    table = sinks.bronze_load(spark, again, f"{tmp_dir}/t", "faers_events", "2024-03-01")
    assert [(r.report_id, r.report_month) for r in table.collect()] == [("1", "202401")]
    assert sorted(r.line for r in sinks.quarantined(spark, f"{tmp_dir}/t", "2024-03-01").collect()) == ["not json", '{"report_id":']


def test_new_checkpoint_keeps_older_batches(spark, tmp_dir):
    def run(name, src):
        ingest.start_ingest(spark, f"{tmp_dir}/out", f"{tmp_dir}/{name}", source="files", path=src,
                            trigger={"availableNow": True}).awaitTermination()
    _lines(f"{tmp_dir}/a", [_message(1), _message(2)])
    run("ck1", f"{tmp_dir}/a")
    _lines(f"{tmp_dir}/b", [_message(3)])
    run("ck2", f"{tmp_dir}/b")
    assert sorted(r.post_id for r in ingest.read_batches(spark, f"{tmp_dir}/out").collect()) == ["1", "2", "3"]


def test_no_limit_of_messages_by_default(spark, tmp_dir):
    for i in range(120):
        _lines(f"{tmp_dir}/in", [_message(i)])
    q = ingest.start_ingest(spark, f"{tmp_dir}/out", f"{tmp_dir}/ck", source="files", path=f"{tmp_dir}/in", trigger={"availableNow": True})
    q.awaitTermination()
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [120]


def test_unreadable_time_has_its_own_reason(spark):
    df = spark.createDataFrame([(_message(1, "soon"),), (_message(2),), (_message(3, None),)], "value string")
    got = [(r.reject_reason, r.created_utc is None) for r in ingest.decode_messages(df).collect()]
    assert got == [("created_utc is not a timestamp", True), (None, False), ("created_utc is null", True)]


def test_ingest_without_a_valid_row(spark, tmp_dir):
    bad = spark.createDataFrame([(None, "d", "1", 30, 70.0, "20240101")],
                                "report_id string, drug_name string, severity string, age int, weight double, report_date string")
    res = jobs.run_ingest(spark, "reports", "2024-01-01", bad, tmp_dir)
    assert spark.read.schema("report_id string").json(res.published).count() == 0
    assert spark.read.parquet(res.quarantine).count() == 1


def test_ingest_labels(spark, tmp_dir):
    rows = [("1", "A", "a", "w", True), ("2", "B", "b", "w", False), (None, "C", "c", "w", True)]
    df = spark.createDataFrame(rows, "drug_id string, brand_name string, generic_name string, warnings string, openfda_present boolean")
    res = jobs.run_ingest(spark, "labels", "2024-01-01", df, tmp_dir)
    assert [r.drug_id for r in spark.read.json(res.published).collect()] == ["1"]
    assert sorted(r.reject_reason for r in spark.read.parquet(res.quarantine).collect()) == ["missing id", "missing openfda"]
    flat = jobs.run_ingest(spark, "labels", "2024-01-02", df.drop("openfda_present").filter("drug_id is not null"), tmp_dir)
    assert spark.read.json(flat.published).count() == 2


def test_route_publishes(spark, tmp_dir):
    df = spark.createDataFrame([("1", 3)], "post_id string, score int")
    start = dt.date(2024, 1, 1)
    for day, n in ((31, 2), (32, 1)):
        for _ in range(2):
            sinks.route(df, f"{tmp_dir}/{day}", sinks.POSTS_SCHEMA, "auto", start, start + dt.timedelta(days=day - 1))
        got = spark.read.parquet(f"{tmp_dir}/{day}")
        assert got.count() == n and got.columns == [c for c, _ in sinks.POSTS_SCHEMA]


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_remove_path(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/x")
    remove_path(spark, f"{tmp_dir}/x")
    assert not os.path.exists(f"{tmp_dir}/x") and spark.range(1).select(F.lit(1)).count() == 1
