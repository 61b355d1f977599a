"""Steps that must be done once, or in less space, however many sinks or marts use their rows."""

import os

from conftest import SF_TINY

from pvspark.operators import sinks

SOURCES = ("lineitem", "events", "documents", "part.parquet")


def _from_source(df):
    return any(s in f for f in df.inputFiles() for s in SOURCES)


def _spy(monkeypatch, module, name, frames):
    seen, real = [], getattr(module, name)

    def call(*args, **kwargs):
        seen.extend(_from_source(df) for df in frames(*args))
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, call)
    return seen


def test_raw_batches_are_compressed(spark, tmp_dir):
    df = spark.range(2000).selectExpr("cast(id as string) report_id", "'A' drug_name", "'20240105' report_date")
    path = sinks.write_batch(df, f"{tmp_dir}/raw", "faers", "2024-01-01")
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert sinks.bronze_load(spark, path, f"{tmp_dir}/t", "faers_events", "2024-01-01").count() == 2000


def test_routed_reports_are_cleaned_once(spark, monkeypatch):
    from pvspark.plans.publish import q_publish_routed
    seen = _spy(monkeypatch, sinks, "route", lambda df, *_: [df])
    got = {r.target: r.n for r in q_publish_routed(spark, SF_TINY).collect()}
    assert seen == [False] * 4 and got["append"] == 2 * got["overwrite"] > 0


def test_saved_tables_are_cleaned_once(spark, monkeypatch):
    from pvspark.plans.publish import q_clean_tables
    seen = _spy(monkeypatch, sinks, "save_table", lambda df, *_: [df])
    assert len(q_clean_tables(spark, SF_TINY).collect()) == 5
    assert seen == [False] * 6


def test_master_and_digest_read_the_clean_tables_written_once(spark, monkeypatch):
    from pvspark.operators import marts, retrieve
    from pvspark.plans import models
    monkeypatch.setattr(models, "_STORED", {})
    built = _spy(monkeypatch, marts, "build_master", lambda reports, *_: [reports])
    asked = _spy(monkeypatch, retrieve, "digest_context", lambda *frames: frames)
    assert models.q_digest_context(spark, SF_TINY).count() > 0
    assert built == [False] and asked == [False, False]
    assert not _from_source(models._clean(spark, SF_TINY, "reports"))      # what the risk report is given


def test_vectors_hold_documents_without_words(spark):
    from pvspark.operators import index
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "beta gamma"), (3, " .. "), (4, None)], "doc_id long, text string")
    built = index.build(docs)
    assert {r.doc: sorted(t.term for t in r.vec) for r in built.vectors.collect()} == {1: ["alpha", "beta"], 2: ["beta", "gamma"], 3: [], 4: []}


def test_scores_meet_only_words_that_queries_have(spark):
    from pvspark.operators import index
    built = index.build(spark.createDataFrame([(1, "alpha beta"), (2, "beta gamma"), (3, "delta")], "doc_id long, text string"))
    terms = spark.createDataFrame([(7, "alpha", 0.6), (7, "beta", 0.8)], "query_id long, term string, qw double")
    pairs = spark.createDataFrame([(7, 1), (7, 2), (7, 3)], "query_id long, doc long")
    scores = index._full_scores(pairs, built, terms)
    assert "LeftSemi" in scores._jdf.queryExecution().optimizedPlan().toString()
    w = {(r.doc, t.term): t.w for r in built.vectors.collect() for t in r.vec}
    want = {1: 0.6 * w[1, "alpha"] + 0.8 * w[1, "beta"], 2: 0.8 * w[2, "beta"]}
    assert {r.doc: round(r.score, 9) for r in scores.collect()} == {d: round(x, 9) for d, x in want.items()}


def test_replay_reads_messages_decoded_once(spark, monkeypatch):
    from pvspark.plans import streams
    from pvspark.streaming import ingest
    seen, real = [], ingest.message_json

    def call(posts, seq):
        seen.append([f for f in posts.inputFiles() if f.endswith(".txt")])
        return real(posts, seq)

    monkeypatch.setattr(ingest, "message_json", call)
    assert {r.passes for r in streams.q_stream_dedup(spark, SF_TINY).collect()} <= {1, 2}
    assert seen == [[], []]


def test_only_objects_are_messages(spark):
    from pvspark.streaming import ingest
    lines = ['{"post_id":"1","body":"b","created_utc":"2024-01-01T00:00:00+00:00"}', ' \t\n{"post_id":"2","body":"b","created_utc":"2024-01-01T00:00:00+00:00"}',
             "[1]", '"{"', "3", "null", "{broken", "", None]
    got = ingest.decode_messages(spark.createDataFrame([(x,) for x in lines], "value string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "schema_of_variant" not in plan
    assert [r.reject_reason for r in got.collect()] == [None, None] + [ingest.DECODE_ERROR] * 7
