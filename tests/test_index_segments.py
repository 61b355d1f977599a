"""The TF-IDF index: words stay in their segments, and lists are as many for any number of keys."""

from pvspark.operators import index

DOCS = [(i, f"alpha w{i % 7} w{i % 5} w{i % 5}", f"k{i}") for i in range(40)] + [(40, None, "k0"), (41, "beta", None)]


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, grp string").repartition(3)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_counted_without_a_shuffle(spark, monkeypatch):
    plans, real = {}, index._stored

    def stored(df, folder, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, folder, name)

    monkeypatch.setattr(index, "_stored", stored)
    index.build(spark.createDataFrame(DOCS, "doc_id long, text string, grp string"))
    assert "Exchange" not in next(iter(plans.values()))
    assert not any("explode" in p and "split(" in p for p in plans.values())


def test_lists_do_not_grow_with_keys(spark):
    docs = _docs(spark).coalesce(1)
    built = index.build(docs, key_col="grp")
    assert built.lists.count() == built.vocabulary.count() == 9
    assert {r.key: r.n for r in built.places.filter("doc = 41 or doc = 3").collect()} == {None: 41, "k3": 24}


def test_small_segments_give_the_same_hits(spark, monkeypatch):
    asked = spark.createDataFrame([(1, "w1 w2 w2", None), (2, "alpha", None), (3, "w3", "k0"), (4, "w0 beta", "k7"), (5, None, None)], "query_id long, text string, want string")

    def hits():
        built = index.build(_docs(spark), key_col="grp")
        return built.places.select("seg").distinct().count(), index.search(built, asked, 6, key_col="want").orderBy("query_id", "rank").collect()

    few, want = hits()
    for name, least in (("PLACES", 2), ("BLOCK", 5), ("LOT", 2)):
        monkeypatch.setattr(index, name, least)
        segments, got = hits()
        assert segments >= few and got == want
    assert segments > 3 * few
    assert [r.doc for r in want if r.query_id == 3] == [0, 40] and [r.doc for r in want if r.query_id == 5] == [0, 1, 2, 3, 4, 5]


def test_scores_open_only_paired_documents(spark):
    built = index.build(_docs(spark))
    scores = index._full_scores(spark.createDataFrame([(7, 3)], "query_id long, doc long"), built,
                                spark.createDataFrame([(7, "w3", 1.0)], "query_id long, term string, qw double"))
    plan = _plan(scores)
    assert plan.count("LeftSemi") == 2 and not any("lambda" in x for x in plan.splitlines() if "Filter" in x)
    assert [r.doc for r in scores.collect()] == [3]


def test_digest_cleans_articles_once(spark, monkeypatch):
    from pvspark.operators import marts
    from pvspark.plans import models
    monkeypatch.setattr(models, "_STORED", {})
    seen, real = [], marts.build_master

    def call(reports, posts, articles, *rest):
        seen.append([f for f in articles.inputFiles() if "documents" in f])
        return real(reports, posts, articles, *rest)

    monkeypatch.setattr(marts, "build_master", call)
    assert models.q_digest_context(spark, "/root/testdata/sf0.001").count() > 0
    assert seen == [[]]


def test_digest_joins_written_hits(spark, monkeypatch):
    from pvspark.operators import retrieve
    seen, real = [], retrieve.context_text

    def call(hits, **kwargs):
        seen.append(_plan(hits))
        return real(hits, **kwargs)

    monkeypatch.setattr(retrieve, "context_text", call)
    articles = spark.createDataFrame([("1", "t", "alpha beta", "A", 2000)], "article_id string, title string, abstract string, drug_name string, publish_year int")
    profiles = spark.createDataFrame([("p", "A", "18-34", "LOW")], "profile_id string, drug_name string, age_group string, risk_label string")
    assert "[1] t (2000):" in retrieve.digest_context(profiles, articles).collect()[0].text
    assert "Aggregate" not in seen[0] and "Window" not in seen[0]
