"""Edge tables for the Column-level rules (literal rows, literal expected values)."""

from pyspark.sql import functions as F

from pvspark.functions import dates, rules, text


def _col(spark, values, typ, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_age_group_edges(spark):
    ages = [None, "-1", "0", "17", "18", "34", "35", "64", "65", "130", "45.0", "abc", ""]
    got = _col(spark, ages, "string", rules.age_group)
    assert got == ["unknown", "0-17", "0-17", "0-17", "18-34", "18-34", "35-64", "35-64", "65+", "65+",
                   "unknown", "unknown", "unknown"]


def test_age_group_truncates_doubles(spark):
    assert _col(spark, [17.9, 34.99, -0.5, None], "double", rules.age_group) == ["0-17", "18-34", "0-17", "unknown"]


def test_severity_parse_and_flag(spark):
    vals = ["1", "2", "3", " 1", "x", None]
    assert _col(spark, vals, "string", rules.lenient_int) == [1, 2, 3, 1, None, None]
    assert _col(spark, vals, "string", rules.flag) == [1, 0, 0, 1, 0, 0]


def test_norm_key_spaces_not_tabs(spark):
    keys = [None, "", "   ", "\t", "Adderall", " adderall ", "ADDERALL"]
    assert _col(spark, keys, "string", rules.norm_key) == [None, "", "", "\t", "ADDERALL", "ADDERALL", "ADDERALL"]


def test_risk_and_label_severity(spark):
    assert _col(spark, [29.99, 30.0, 69.99, 70.0], "double", rules.risk_label) == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]
    assert _col(spark, [499, 500, 1999, 2000, None], "int", rules.label_severity) == \
        ["LOW", "MEDIUM", "MEDIUM", "HIGH", "LOW"]


def test_split_interactions(spark):
    got = _col(spark, [None, "", "A", "A, B", "A,,B", " A ,\tB\t", "  "], "string", rules.split_interactions)
    assert got == [[], [], ["A"], ["A", "B"], ["A", "B"], ["A", "B"], []]


def test_pct_format_half_even(spark):
    got = _col(spark, [2.25, 2.35, 0.05, 99.95, 1234.56], "double", rules.pct1)
    # Python's '{:.1f}' on the same doubles
    assert got == [f"{v:.1f}" for v in [2.25, 2.35, 0.05, 99.95, 1234.56]]


def test_tag_all_and_first(spark):
    rows = [("I took adderall and XANAX",), ("nothing here",), (None,), ("",), ("fentanyl, adderall",)]
    df = spark.createDataFrame(rows, "t string")
    out = df.select(text.tag_all("t", text.DRUG_KEYWORDS).alias("a"),
                    text.tag_first("t", text.DRUG_KEYWORDS).alias("f")).collect()
    assert [r.a for r in out] == ["Adderall,Xanax", "unknown", "unknown", "unknown", "Adderall,Fentanyl"]
    assert [r.f for r in out] == ["Adderall", "unknown", "unknown", "unknown", "Adderall"]


def test_contains_any_null_is_false(spark):
    assert _col(spark, [None, "Cold Turkey now", "fine"], "string",
                lambda c: text.contains_any(c, text.WITHDRAWAL_TERMS)) == [False, True, False]


def test_match_dictionary_against_contains(spark):
    import random
    rng = random.Random(1)
    terms = {"".join(rng.choices("abAB ", k=rng.randrange(1, 7))) for _ in range(300)} | {"abab", "ABAB", "é", ""}
    texts = ["".join(rng.choices("abc ABé", k=rng.randrange(0, 30))) for _ in range(80)] + [None, "", "ab", "ab"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, text string, terms0 string")
    d = spark.createDataFrame([(t,) for t in [*terms, None, "ab"]], "term string")
    got = {r.i: r.terms for r in text.match_dictionary(df, F.col("text"), d).collect()}
    for i, t in enumerate(texts):
        want = sorted(x for x in terms | {"ab"} if x and x.lower() in (t or "").lower())
        assert (got[i] or []) == want
    tagged = {r.i: r.m for r in text.tag_dictionary(df, F.col("text"), d.limit(0), out="m").collect()}
    assert set(tagged.values()) == {"unknown"} and len(tagged) == len(texts)



def test_pub_date_forms(spark):
    rows = [("2001", "Mar", None), ("2001", "3", None), ("2001", None, None), (None, None, "1998 Dec-1999 Jan"),
            (None, None, "Spring 2000"), ("2001", "13", None), (None, None, None), ("2001", "123", None)]
    df = spark.createDataFrame(rows, "y string, m string, md string")
    got = [r[0] for r in df.select(dates.pub_date("y", "m", "md")).collect()]
    assert got == ["2001-03-01", "2001-03-01", "2001-01-01", "1998-01-01", None, "2001-13-01", None, "2001-123-01"]


def test_report_date_parse(spark):
    got = _col(spark, ["20240131", "20241341", "2024", None], "string", dates.report_date)
    assert [str(x) if x else None for x in got] == ["2024-01-31", None, None, None]


def test_match_dictionary_equals_contains(spark, monkeypatch):
    """Short and long terms, texts across pieces, a filter so small that it lets much pass, nulls and no rows."""
    import random

    from pyspark.sql import functions as F

    from pvspark.functions import text as t
    monkeypatch.setattr(t, "PIECE", 16)
    rng = random.Random(8)
    letters = "abcdé "
    texts = [None, "", "a", "ABC"] + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 120))) for _ in range(150)]
    terms = sorted({"".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 9]))) for _ in range(120)} | {"", None, "ABC", "é"}, key=str)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    words = spark.createDataFrame([(w,) for w in terms], "term string")
    want = {i: sorted(w for w in terms if w and w.lower() in (x or "").lower()) or None for i, x in enumerate(texts)}
    for most in (1, t.FILTER_WORDS):
        monkeypatch.setattr(t, "FILTER_WORDS", most)
        got = {r.i: r.terms for r in t.match_dictionary(df, F.col("x"), words).collect()}
        assert got == want
    assert all(r.terms is None for r in t.match_dictionary(df, F.col("x"), words.limit(0)).collect())
    assert t.match_dictionary(df.limit(0), F.col("x"), words).collect() == []


def test_texts_meet_few_terms_of_a_large_dictionary(spark):
    """Terms of the same pieces: what a text is handed must not grow with the dictionary."""
    from itertools import product

    from pvspark.functions import text as t
    words = [f"{a}ring{b}" for a, b in product("abcdefghijklmnopqrstuvwxyz", repeat=2)] + ["kring", "ri", "Zring"]
    texts = [f"{'z' * k}{words[k].upper()} and {words[-7 - k]}" for k in range(0, 600, 7)]
    rows = spark.createDataFrame([(x.lower(), i) for i, x in enumerate(texts)], "__hay string, __h long")
    pairs = {(r["__h"], r.t) for r in t._candidates(rows, spark.createDataFrame([(w,) for w in words], "term string"), "term").collect()}
    real = {(i, w) for i, x in enumerate(texts) for w in words if w.lower() in x.lower()}
    assert real <= pairs and len(pairs) <= 2 * len(real)
