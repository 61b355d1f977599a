"""Operator tests on hand-written edge tables: dedup, marts, quality, validity, sinks, jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pvspark.operators import dedup, marts, quality, silver, sinks, validate


# ---- dedup ---------------------------------------------------------------------------------

DEDUP_ROWS = [(None, 1, "a"), (None, 2, "b"), ("k1", 5, "x"), ("k1", 5, "w"), ("k1", 3, "z"),
              ("k2", 1, "same"), ("k2", 1, "same"), ("k3", None, "n"), ("k3", 2, "m")]


def _dedup_df(spark):
    return spark.createDataFrame(DEDUP_ROWS, "id string, ts int, v string")


@pytest.mark.parametrize("method", ["window", "min_by"])
def test_dedup_latest_total_order(spark, method):
    out = dedup.dedup_latest(_dedup_df(spark), "id", ["ts desc", "v"], method=method)
    got = sorted((r.id or "", r.ts, r.v) for r in out.collect())
    # NULL keys form one group; ts desc (nulls last) then v asc
    assert got == [("", 2, "b"), ("k1", 5, "w"), ("k2", 1, "same"), ("k3", 2, "m")]


def test_dedup_idempotent_and_shuffle_invariant(spark):
    df = _dedup_df(spark)
    once = dedup.dedup_latest(df, "id", ["ts desc", "v"])
    twice = dedup.dedup_latest(once, "id", ["ts desc", "v"])
    shuffled = dedup.dedup_latest(df.repartition(7, "v").orderBy(F.rand(3)), "id", ["ts desc", "v"])
    key = lambda d: sorted(tuple(r) for r in d.fillna("").collect())
    assert key(once) == key(twice) == key(shuffled)


def test_upsert_latest(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, label string, version int")
    new = spark.createDataFrame([(2, "B", 2), (3, "C", 2)], "id int, label string, version int")
    got = sorted(tuple(r) for r in dedup.upsert_latest(old, new, "id", "version").collect())
    assert got == [(1, "a", 1), (2, "B", 2), (3, "C", 2)]


# ---- silver + marts -------------------------------------------------------------------------

def _reports(spark, rows):
    schema = ("report_id string, drug_name string, reaction string, severity string, age string, weight string, "
              "report_date string, hospitalization string, death string, disability string, ingestion_ts timestamp")
    return spark.createDataFrame(rows, schema)


def test_clean_reports_rules(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("1", " drugA ", "r1", "1", "45.0", "70", "20240101", "1", "0", "n/a", t),
            ("2", "   ", "r1", "1", "30", "70", "20240101", None, None, None, t),
            ("3", None, "r1", "1", "30", "70", "20240101", None, None, None, t),
            ("4", "drugA", None, "x", "130", "abc", "20241341", None, "1", "1", t)]
    out = {r.report_id: r for r in silver.clean_reports(_reports(spark, rows)).collect()}
    assert set(out) == {"1", "4"}
    a = out["1"]
    assert (a.drug_name, a.age, a.age_group, a.is_serious, a.hospitalization, a.disability) == \
        ("DRUGA", None, "unknown", True, 1, 0)
    b = out["4"]
    assert (b.severity, b.is_serious, b.report_date, b.age_group, b.weight) == (None, None, None, "65+", None)


def test_adverse_profile_ties_and_distribution(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(str(i), d, r, "1", a, "1", "20240101", "1", "0", "0", t) for i, (d, r, a) in enumerate([
        ("A", "zeta", "10"), ("A", "alpha", "20"), ("A", "zeta", "40"), ("A", "alpha", "70"),  # tie -> alpha
        ("B", None, None), ("B", None, "5")])]                                                # no reaction
    s = silver.clean_reports(_reports(spark, rows))
    got = {r.drug_name: r for r in marts.adverse_profile(s).collect()}
    assert got["A"].most_common_reaction == "alpha"
    assert got["A"].age_group_distribution == '{"0-17":1,"18-34":1,"35-64":1,"65+":1}'
    assert got["B"].most_common_reaction is None
    assert got["B"].age_group_distribution == '{"0-17":1,"unknown":1}'
    assert got["A"].avg_age == pytest.approx(35.0) and got["B"].avg_age == pytest.approx(5.0)
    joined = {r.drug_name: tuple(r) for r in marts.adverse_profile_joined(s).collect()}
    assert joined == {k: tuple(v) for k, v in got.items()}
    arr = {r.drug_name: r.age_group_distribution for r in marts.adverse_profile(s, "array").collect()}
    assert arr["B"] == '[{"age_group":"0-17","ag_cnt":1},{"age_group":"unknown","ag_cnt":1}]'


def test_sentiment_keys_and_distinct_forums(spark):
    rows = [("p1", "f1", 10, "b", "Adderall, Xanax"), ("p2", "f2", 20, "bb", "adderall"),
            ("p3", "f1", None, "bbb", "A,,B"), ("p4", "f1", 5, "b", None), ("p5", "f3", 1, "b", "unknown")]
    posts = spark.createDataFrame(rows, "post_id string, subreddit string, score int, body string, drug_mentions string") \
        .withColumn("body_length", F.length("body"))
    norm = {r.drug_name: r for r in marts.sentiment_profile(posts).collect()}
    assert norm["ADDERALL"].total_mentions == 2 and norm["ADDERALL"].subreddit_count == 2
    assert norm["ADDERALL"].avg_score == pytest.approx(15.0)
    assert "" not in norm and "UNKNOWN" in norm and norm["B"].avg_score is None
    exact = {r.drug_name for r in marts.sentiment_profile(posts, key_mode="exact").collect()}
    assert {"Adderall", "adderall", "Xanax", "unknown"} <= exact


def test_label_sentinel_three_valued(spark):
    rows = [("1", "unknown", "unknown", None, None), ("2", "unknown", "X", "w", "short"),
            ("3", None, "unknown", "w", None), ("4", None, "X", "w", "0123456789a")]
    lab = spark.createDataFrame(rows, "drug_id string, brand_name string, generic_name string, warnings string, interactions string")
    out = {r.drug_id: r for r in silver.clean_labels(lab).collect()}
    assert set(out) == {"2", "4"}
    assert out["4"].has_interactions is True and out["2"].has_interactions is False


# ---- quality --------------------------------------------------------------------------------

def test_each_check_pass_and_fail(spark):
    good = spark.createDataFrame([("a", 1, "20240101", "abcdefghijk"), ("b", 2, "20240102", "abcdefghijk")],
                                 "id string, sev int, d string, txt string")
    bad = spark.createDataFrame([("a", 3, "2024", "short"), ("a", None, None, None)],
                                "id string, sev int, d string, txt string")
    checks = [quality.not_null("sev"), quality.unique("id"), quality.in_set("sev", [1, 2]),
              quality.between("sev", 0, 2), quality.regex("d", r"^\d{8}$"), quality.length_between("txt", 10, 100)]
    g = {r.check_name: r.success for r in quality.run_suite(good, checks, "t").collect()}
    b = {r.check_name: (r.success, r.unexpected) for r in quality.run_suite(bad, checks, "t").collect()}
    assert all(g.values())
    assert b == {"not_null": (False, 1), "unique": (False, 2), "in_set": (False, 1), "between": (False, 1),
                 "regex": (False, 1), "length_between": (False, 1)}


def test_quality_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "id string")
    r = {x.check_name: (x.total, x.unexpected, x.success)
         for x in quality.run_suite(empty, [quality.not_null("id"), quality.unique("id")]).collect()}
    assert r == {"not_null": (0, 0, True), "unique": (0, 0, True)}
    nulls = spark.createDataFrame([(None,), (None,)], "id string")
    r = {x.check_name: x.success for x in quality.run_suite(nulls, [quality.not_null("id"), quality.unique("id"),
                                                                   quality.in_set("id", ["a"])]).collect()}
    assert r == {"not_null": False, "unique": True, "in_set": True}


def test_mostly(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (500,)], "x int")
    ok = quality.run_suite(df, [quality.between("x", 0, 10, mostly=0.75)]).collect()[0]
    no = quality.run_suite(df, [quality.between("x", 0, 10, mostly=0.8)]).collect()[0]
    assert ok.success and not no.success


def test_gate_raises_and_unknown_suite(spark):
    df = spark.createDataFrame([("a",), ("a",)], "drug_id string")
    with pytest.raises(quality.QualityGateError):
        quality.gate(quality.run_suite(df, [quality.unique("drug_id")], "labels"))
    with pytest.raises(quality.QualityGateError):
        quality.run_named_suite(df, "nope")


# ---- validity ---------------------------------------------------------------------------------

def test_report_rules_first_failure_wins(spark):
    rows = [(None, None, "x"), ("", "d", "1"), ("1", None, "1"), ("2", "   ", "2"), ("3", "d", "3"), ("4", "d", None)]
    df = spark.createDataFrame(rows, "report_id string, drug_name string, severity string")
    valid, rej = validate.split_valid(df, validate.report_rules())
    assert sorted(r.report_id for r in valid.collect()) == ["2"]          # '   ' is truthy
    got = sorted((r.report_id or "-", r.reject_reason) for r in rej.collect())
    assert got == [("-", "missing report_id"), ("-", "missing report_id"), ("1", "missing drug_name"),
                   ("3", "invalid severity"), ("4", "invalid severity")]
    counts = {r.reason: r.n for r in validate.reject_counts(validate.tag(df, validate.report_rules()), "r").collect()}
    assert sum(counts.values()) == len(rows)


# ---- sinks / jobs -----------------------------------------------------------------------------

def test_router_boundaries():
    start = dt.date(2024, 1, 1)
    assert sinks.choose_target("auto", start, start + dt.timedelta(days=30)) == "append"
    assert sinks.choose_target("auto", start, start + dt.timedelta(days=31)) == "overwrite"
    assert sinks.choose_target("Overwrite") == "overwrite"
    with pytest.raises(ValueError):
        sinks.choose_target("elsewhere")


def test_project_to_schema(spark):
    df = spark.createDataFrame([("1", "7", ["a", "b"], "extra")], "report_id string, age string, drug_list array<string>, x string")
    out = sinks.project_to_schema(df, [("report_id", "VARCHAR"), ("age", "INTEGER"), ("drug_list", "VARCHAR"),
                                       ("missing", "DATE")])
    assert out.columns == ["report_id", "age", "drug_list", "missing"]
    r = out.collect()[0]
    assert (r.report_id, r.age, r.drug_list, r.missing) == ("1", 7, "a,b", None)


def test_key_value_roundtrip_and_batches(spark, tmp_dir):
    df = spark.createDataFrame([("p1", 3), (None, 4)], "post_id string, score int")
    kv = sinks.to_key_value(df, "post_id")
    back = kv.select(F.from_json("value", "post_id string, score int").alias("r")).select("r.*")
    assert sorted(tuple(r) for r in back.fillna("").collect()) == sorted(tuple(r) for r in df.fillna("").collect())
    p = sinks.write_batch(df, tmp_dir, "reddit", "2024-01-01")
    sinks.write_batch(df, tmp_dir, "reddit", "2024-01-01")                 # rerun overwrites
    assert spark.read.json(p).count() == 2


def test_ingest_gate_blocks_publish(spark, tmp_dir):
    from pvspark.operators import jobs
    good = spark.createDataFrame([("1", "d", "1", 30, 70.0, "20240101")],
                                 "report_id string, drug_name string, severity string, age int, weight double, report_date string")
    res = jobs.run_ingest(spark, "reports", "2024-01-01", good, tmp_dir)
    assert spark.read.json(res.published).count() == 1
    dup = good.unionByName(good)
    with pytest.raises(quality.QualityGateError):
        jobs.run_ingest(spark, "reports", "2024-01-02", dup, tmp_dir)
    import os
    assert not os.path.exists(f"{tmp_dir}/reports/ds=2024-01-02")


def test_read_ndjson_corrupt_and_multiline(spark, tmp_dir):
    from pyspark.sql import types as T

    from pvspark.sources.tables import read_ndjson
    with open(f"{tmp_dir}/b.json", "w") as f:
        f.write('{"report_id":"1","age":3}\nnot json\n{"report_id":"2","age":"x"}\n')
    with open(f"{tmp_dir}/m.json", "w") as f:
        f.write('[{"report_id":"1","age":3},\n {"report_id":"2","age":4}]')
    schema = T.StructType([T.StructField("report_id", T.StringType()), T.StructField("age", T.IntegerType())])
    rows = read_ndjson(spark, f"{tmp_dir}/b.json", schema).cache().collect()
    assert len(rows) == 3 and sum(1 for r in rows if r._corrupt_record is not None) == 2
    multi = read_ndjson(spark, f"{tmp_dir}/m.json", schema, multi_line=True).collect()
    assert sorted(r.report_id for r in multi) == ["1", "2"]


def test_raw_ddl_and_save_table(spark, tmp_dir):
    made = sinks.create_raw_tables(spark, "pv_raw_test", location=f"{tmp_dir}/db")
    assert len(made) == 4
    cols = spark.table("pv_raw_test.faers_events").columns
    assert "report_month" in cols and "drug_name" in cols
    df = spark.createDataFrame([("1", "A")], "report_id string, drug_name string")
    sinks.save_table(df, "pv_raw_test.clean_reports")
    sinks.save_table(df.unionByName(df), "pv_raw_test.clean_reports")          # create-or-replace
    assert spark.table("pv_raw_test.clean_reports").count() == 2
    sinks.register_views({"stg_reports": spark.table("pv_raw_test.clean_reports")})
    assert spark.sql("select count(*) c from stg_reports").collect()[0].c == 2
    spark.sql("DROP DATABASE pv_raw_test CASCADE")


def test_display_rows_found_and_missing(spark):
    from pvspark.operators.score import NOT_FOUND, display_rows
    rep = spark.createDataFrame(
        [("r1", "A", 30, 0.05, 12.25, 1.0, 0.0, "LOW", None, 0, 0.0, 0.0, 0.0, 0.0, [], [], "LOW")],
        "request_id string, drug_name string, age int, serious_reaction_pct double, hospitalization_pct double, "
        "death_pct double, disability_pct double, risk_label string, top_risk_factor string, total_research_papers int, "
        "community_concern_score double, research_risk_consensus double, dependency_mention_rate double, "
        "withdrawal_mention_rate double, top_5_reactions array<struct<reaction:string,frequency_pct:double>>, "
        "known_interactions array<string>, label_warning_severity string")
    miss = spark.createDataFrame([("r2", "Nope", 40)], "request_id string, drug_name string, age int")
    out = {r.request_id: r for r in display_rows(rep, miss).collect()}
    a, b = out["r1"], out["r2"]
    assert (a.serious, a.hospitalization, a.top_risk_factor, a.interactions, a.reactions, a.age_group) == \
        (f"{0.05:.1f}%", f"{12.25:.1f}%", "N/A", "None reported", "N/A", "18-34")
    assert (b.status, b.risk_label, b.serious, b.age_group) == (NOT_FOUND, "UNKNOWN", "N/A", "35-64")


def test_digest_context_filters_by_drug(spark):
    from pvspark.operators.retrieve import digest_context
    arts = spark.createDataFrame(
        [("1", "t1", "aspirin bleeding risk in older adults", "ASPIRIN", 2001),
         ("2", "t2", "aspirin and stomach ulcers adverse effects", "ASPIRIN", 2002),
         ("3", "t3", "ibuprofen kidney toxicity adverse effects", "IBUPROFEN", 2003)],
        "article_id string, title string, abstract string, drug_name string, publish_year int")
    prof = spark.createDataFrame([("p1", "ASPIRIN", "65+", "HIGH"), ("p2", "NONE", "0-17", "LOW")],
                                 "profile_id string, drug_name string, age_group string, risk_label string")
    out = {r.profile_id: r.text for r in digest_context(prof, arts, k=5).collect()}
    assert "[1] t1 (2001):" in out["p1"] and "[2] t2 (2002):" in out["p1"] and "[3]" not in out["p1"]
    assert out["p2"] == "No relevant research found for NONE."


def test_bronze_load_idempotent_per_day(spark, tmp_dir):
    rows = [("1", "A", "r", "1", "30", "70", "20240105", None, "0", "0"),
            ("2", "B", "r", "2", "40", "70", "20240210", None, "0", "0")]
    df = spark.createDataFrame(rows, "report_id string, drug_name string, reaction string, severity string, "
                                     "age string, weight string, report_date string, hospitalization string, "
                                     "death string, disability string")
    p1 = sinks.write_batch(df, f"{tmp_dir}/raw", "faers", "2024-03-01")
    p2 = sinks.write_batch(df.limit(1), f"{tmp_dir}/raw", "faers", "2024-03-02")
    sinks.bronze_load(spark, p1, f"{tmp_dir}/t", "faers_events", "2024-03-01")
    sinks.bronze_load(spark, p2, f"{tmp_dir}/t", "faers_events", "2024-03-02")
    t = sinks.bronze_load(spark, p1, f"{tmp_dir}/t", "faers_events", "2024-03-01")      # rerun day 1
    got = sorted((r.ds, r.report_month, r.report_id) for r in t.collect())
    assert got == [("2024-03-01", "202401", "1"), ("2024-03-01", "202402", "2"), ("2024-03-02", "202401", "1")]
    assert dict(t.dtypes)["report_month"] == "string"


def test_sentiment_approx_distinct_close(spark):
    rows = [(f"p{i}", f"f{i % 7}", i, "b", "Adderall") for i in range(200)]
    posts = spark.createDataFrame(rows, "post_id string, subreddit string, score int, body string, drug_mentions string") \
        .withColumn("body_length", F.length("body"))
    exact = marts.sentiment_profile(posts).collect()[0]
    approx = marts.sentiment_profile(posts, distinct="approx").collect()[0]
    assert exact.subreddit_count == 7 and abs(approx.subreddit_count - 7) <= 1
    assert (exact.total_mentions, exact.avg_score) == (approx.total_mentions, approx.avg_score)


def test_extract_labels_array_or_string_fields(spark):
    from pvspark.sources import extract
    long = "w" * 501
    docs = [
        '{"id":"1","openfda":{"brand_name":["A","B"],"generic_name":[]},"warnings":["x","y"],"drug_interactions":"plain"}',
        '{"id":"2","openfda":{"brand_name":"notalist"},"warnings":[null],"drug_interactions":[]}',
        '{"id":"3","openfda":{},"warnings":"' + long + '"}',
        '{"id":"4","openfda":null,"warnings":"w"}',
        '{"openfda":{},"warnings":"w"}',
        'not json',
    ]
    df = extract.label_variant(spark.createDataFrame([(d,) for d in docs], "value string"))
    df = df.withColumn("drug_id", F.try_variant_get("v", "$.id", "string"))
    from pvspark.operators import validate
    valid, rej = validate.split_valid(df, validate.label_rules(extract.label_openfda_present(F.col("v"))))
    out = {r.drug_id: r for r in extract.extract_labels(valid, clip=500).collect()}
    assert set(out) == {"1", "2", "3"}
    assert (out["1"].brand_name, out["1"].generic_name, out["1"].warnings, out["1"].interactions) == \
        ("A", "unknown", "x", "plain")
    assert (out["2"].brand_name, out["2"].warnings, out["2"].interactions) == ("unknown", None, None)
    assert len(out["3"].warnings) == 500 and out["3"].interactions is None
    reasons = sorted(r.reject_reason for r in rej.collect())
    assert reasons == ["missing id", "missing id", "missing openfda"]


def test_extract_articles_leading_text_semantics(spark):
    from pvspark.sources import extract
    xml = ("<PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>About Xanax use</ArticleTitle>"
           "<Abstract><AbstractText>lead <i>x</i> tail</AbstractText><AbstractText><b>bold</b> only</AbstractText>"
           "<AbstractText></AbstractText><AbstractText> second &amp; part </AbstractText></Abstract>"
           "<Journal><JournalIssue><PubDate><MedlineDate>1998 Dec-1999 Jan</MedlineDate></PubDate></JournalIssue>"
           "</Journal></Article></MedlineCitation></PubmedArticle>")
    empty = ("<PubmedArticle><MedlineCitation><PMID>8</PMID><Article><ArticleTitle></ArticleTitle>"
             "<Abstract><AbstractText>  </AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>")
    df = spark.createDataFrame([(xml,), (empty,)], "xml string")
    out = {r.article_id: r for r in extract.extract_articles(df).collect()}
    a = out["7"]
    # ElementTree .text: leading text only; a part starting with a child contributes nothing
    assert a.abstract == "lead " + " " + " second & part"   # parts joined by a space, then stripped
    assert (a.title, a.publish_date, a.drug_name) == ("About Xanax use", "1998-01-01", "Xanax")
    b = out["8"]
    assert (b.title, b.abstract, b.publish_date, b.drug_name) == (None, None, None, "unknown")


def test_upsert_buckets_rewrites_touched_buckets_only(spark, tmp_dir):
    old = spark.createDataFrame([(i, f"v{i}", 1) for i in range(200)], "id long, v string, version int")
    path = f"{tmp_dir}/t"
    dedup.create_buckets(old, path, "id", 16)

    def files():
        return {r.f: (r.b, r.m) for r in spark.read.parquet(path).select(
            F.col("_metadata.file_path").alias("f"), F.col("bucket").alias("b"), F.col("_metadata.file_modification_time").alias("m")).distinct().collect()}

    before = files()
    new = spark.createDataFrame([(3, "new", 2), (7, "stale", 0), (1000, "added", 1)], "id long, v string, version int")
    touched = dedup.upsert_buckets(path, new, "id", "version", 16)
    after = files()
    assert {f: x for f, x in before.items() if x[0] not in touched} == {f: x for f, x in after.items() if x[0] not in touched}
    assert all(f not in before for f, (b, _) in after.items() if b in touched) and 0 < len(touched) <= 3
    got = {r.id: (r.v, r.version) for r in spark.read.parquet(path).collect()}
    assert len(got) == 201 and got[3] == ("new", 2) and got[7] == ("v7", 1) and got[1000] == ("added", 1)
    assert dedup.upsert_buckets(path, new.limit(0), "id", "version", 16) == []


def test_sketches_of_days_merge_to_one_run(spark):
    rows = [("2024-01-%02d 10:00:00" % (1 + i % 9), f"f{i % 700}", i % 5, 10, "A,b" if i % 2 else "B") for i in range(3000)]
    posts = spark.createDataFrame(rows, "created_utc string, subreddit string, score int, body_length int, drug_mentions string").withColumn(
        "created_utc", F.col("created_utc").cast("timestamp"))
    daily = marts.sentiment_daily(posts)
    merged = {r.drug_name: r for r in marts.sentiment_merge(daily).collect()}
    exact = {r.drug_name: r for r in marts.sentiment_profile(posts).collect()}
    for d, r in exact.items():
        assert (merged[d].total_mentions, merged[d].avg_score, merged[d].avg_body_length) == (r.total_mentions, r.avg_score, r.avg_body_length)
        assert abs(merged[d].subreddit_count - r.subreddit_count) <= 0.05 * r.subreddit_count
    some = marts.sentiment_merge(daily.filter("day <= '2024-01-04'"))
    once = marts.sentiment_merge(marts.sentiment_daily(posts.filter("created_utc < '2024-01-05'")))
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, once.collect()))


def test_staging_write_counts_its_rows(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "a"), (4, "b")], "id int, reject_reason string")
    assert validate.write_split(df, f"{tmp_dir}/s", reasons=["a", "b", "c"]) == {"kept": 1, "dropped": 3, "a": 2, "b": 1, "c": 0}
    assert validate.write_split(df.limit(0), f"{tmp_dir}/e", reasons=["a"]) == {"kept": 0, "dropped": 0, "a": 0}
