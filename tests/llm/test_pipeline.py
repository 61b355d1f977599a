"""The pipeline's stages on a small corpus with planted cases, and its contract."""

import random

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(rng, n):
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    sf = str(tmp_path_factory.mktemp("sf"))
    rows, labels = [], []
    for i in range(160):
        w = _prose(rng, rng.randrange(40, 120)).split()
        if i % 8 == 0:
            w[3:3] = rng.choices(["vile", "nasty", "awful", "creep"], k=4)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 8 == 0)))
    item = _prose(rng, 30)
    base = rows[1][1].split()
    near = base[:20] + ["changed"] + base[21:]
    rows += [(200, rows[2][1]), (201, rows[2][1].upper()), (202, " ".join(near)), (203, _prose(rng, 40) + " " + item),
             (204, None), (205, ""), (206, _prose(rng, 5000))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(7, item), (8, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, {i for i, _ in rows}


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]


def test_each_stage_takes_its_cases_and_no_others(spark, corpus, tmp_path):
    sf, ids = corpus
    gone = {"toxicity": set(range(0, 160, 8)), "exact_dedup": {2, 200, 204}, "near_dedup": {202}, "decontamination": {203}}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(kept) == len(set(kept)) and ids - set(kept) == gone[name], name
        ids = set(kept)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in last} == ids
    run = corpus_pipeline.run(spark, sf)
    assert sorted(map(str, run.collect())) == sorted(map(str, last))


def test_empty_documents(spark, corpus):
    sf, _ = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_toxicity_stage_takes_what_op10_calls_toxic(spark, corpus, monkeypatch):
    sf, _ = corpus
    docs = spark.createDataFrame([(1, 0.29), (2, 0.3), (3, 0.4), (4, 0.6)], "doc_id long, p double")
    monkeypatch.setattr(corpus_pipeline.toxic_segments, "fit", lambda *_, **__: None)
    monkeypatch.setattr(corpus_pipeline.toxic_segments, "score",
                        lambda d, _: d.selectExpr("struct(*) AS row", "p AS score"))
    assert [r.doc_id for r in corpus_pipeline.toxicity(spark, docs, sf).collect()] == [1]
