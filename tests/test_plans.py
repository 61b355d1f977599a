"""Plan shape assertions, known answers at sf0.01, the driver contract, and every registered
query against its DuckDB oracle at sf0.001."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL, SF_TINY

sys.path.insert(0, os.path.join(ROOT, "tools"))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _qs():
    import __spark_entry__ as E
    return E.queries(), E.oracle_sql()


def test_entry_contract(spark):
    import __spark_entry__ as E
    qs, ors = _qs()
    assert set(ors) <= set(qs)
    df = E.entry(spark)
    assert df.count() > 0 and "adv_total_reports" in df.columns


def test_adverse_mart_single_fact_scan(spark):
    from pvspark.plans.layers import adverse_df
    p = _plan(adverse_df(spark, SF_TINY))
    assert p.count("lineitem.parquet") == 1
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_dedup_plans_window_group_limit(spark):
    from pvspark.plans.layers import silver_reports_df
    df = silver_reports_df(spark, SF_TINY)
    df.explain()  # noqa: keep plan in test output on failure
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_master_has_no_cartesian_or_python(spark):
    from pvspark.plans.layers import master_df
    p = _plan(master_df(spark, SF_TINY))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p


def test_scan_pruning_and_pushdown(spark):
    from pvspark.operators.posts import filter_safety_terms
    from pvspark.sources.tables import read_table
    ev = read_table(spark, SF_TINY, "events").withColumnRenamed("event_type", "subreddit") \
        .withColumnRenamed("props", "body").select("subreddit", "body")
    df = filter_safety_terms(ev.withColumn("title", ev["body"]), ["click"], ["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan \
        or "In(event_type" in plan or "EqualTo(event_type,click)" in plan
    assert "ReadSchema: struct<event_type:string,props:string>" in plan


def test_known_answers_sf001(spark):
    from pyspark.sql import functions as F

    from pvspark.plans.layers import silver_reports_df
    s = silver_reports_df(spark, SF_SMALL).cache()
    assert s.count() == 44889
    assert s.filter(F.col("report_date").isNotNull()).count() == 44485
    r = s.agg(F.count("age").alias("n"), F.sum("age").alias("t")).collect()[0]
    assert (r.n, r.t) == (37733, 1940244)
    assert s.filter(F.col("severity") == 1).count() == 22246
    from pvspark.operators import marts
    top = {x.drug_name: (x.most_common_reaction, x.n) for x in
           marts.top_reaction(marts.reaction_counts(marts.adverse_cube(s))).collect()}
    assert top["BLUE ANVIL"] == ("Brand#10", 70)
    adv = marts.adverse_profile(s)
    import json
    for row in adv.collect():                        # sum over the age distribution = total reports
        assert sum(json.loads(row.age_group_distribution).values()) == row.total_reports
    s.unpersist()


SLOW = {"model_metrics", "risk_report", "risk_summary_text", "attribution_rank"}


def _oracle_names():
    _, ors = _qs()
    return sorted(ors)


@pytest.mark.parametrize("name", _oracle_names())
def test_query_matches_duckdb_oracle(spark, name):
    import duckdb

    from oracle_check import _digest
    from pvspark.sources.tables import TABLES
    qs, ors = _qs()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_TINY}/{t}.parquet')")
    sdf = qs[name](spark, SF_TINY)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(ors[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    types = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}
    dtypes = {c: str(t) for c, t in zip(con.sql(ors[name]).columns, con.sql(ors[name]).types)}
    assert {c: types.get(t, t) for c, t in sdf.dtypes} == dtypes
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows)[0] == _digest(dcols, drows)[0]


def test_split_covers_all_drugs(spark):
    qs, _ = _qs()
    rows = {r.split: r.rows for r in qs["split_stable"](spark, SF_TINY).collect()}
    assert set(rows) <= {"train", "test"} and sum(rows.values()) == qs["features"](spark, SF_TINY).count()


def test_tfidf_knn_ranks(spark):
    qs, _ = _qs()
    got = {}
    for r in qs["tfidf_knn"](spark, SF_TINY).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.doc_id
    assert got and all(sorted(v) == [1, 2, 3, 4, 5] and len(set(v.values())) == 5 for v in got.values())


def test_model_metrics_bounds(spark):
    qs, _ = _qs()
    got = {(r.target, r.metric): r.value for r in qs["model_metrics"](spark, SF_TINY).collect()}
    assert len(got) == 12 and all(0.0 <= v <= 1.0 for (_, m), v in got.items() if m != "log_loss")
    assert all(v >= 0.0 for (_, m), v in got.items() if m == "log_loss")


def test_attribution_ranks_are_complete(spark):
    qs, _ = _qs()
    got = {}
    for r in qs["attribution_rank"](spark, SF_TINY).collect():
        got.setdefault(r.key, []).append((r.rank, r.feature, abs(r.contribution)))
    assert got
    for rows in got.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11)) and len({r[1] for r in rows}) == 10
        assert all(a[2] >= b[2] for a, b in zip(rows, rows[1:], strict=False))


def test_baseline_mode_ties_are_deterministic(spark):
    from pvspark.operators.model import baselines
    df = spark.createDataFrame([(f"D{i}", "a") for i in range(9, -1, -1)], "drug_name string, age_group string")
    for n in (1, 3, 7):
        assert baselines(df.repartition(n), continuous=[]).collect()[0].drug_name == "D0"
