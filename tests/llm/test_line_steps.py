"""op7: halves of a line are cut once, and texts are read twice, not three times."""

import random

from pyspark.sql import functions as F

from pvspark.llm import line_neighbours
from test_llm_operators import frame


def test_halves_are_those_of_both_lengths(spark):
    rows = [(n, " ".join(f"w{k}" for k in range(n))) for n in range(8, 20)]
    df = spark.createDataFrame(rows, "n int, words string")
    got = df.select("n", line_neighbours._halves(F.col("n"), F.col("words")).alias("x")).collect()

    def pieces(n, m):
        w = [f"w{k}" for k in range(n)]
        return [("head", m, " ".join(w[:m // 2])), ("tail", m, " ".join(w[n - (m - m // 2):]))]

    want = spark.createDataFrame([(n, i, *x) for n, _ in rows for i, x in enumerate(pieces(n, n) + pieces(n, n - 1))],
                                 "n int, i int, side string, m int, part string")
    keys = {(r.n, r.i): (r.h, r.side == "head") for r in want.select("n", "i", "side", F.xxhash64("side", "m", "part").alias("h")).collect()}
    for r in got:
        assert [(x.half, x.head) for x in r.x] == [keys[r.n, i] for i in range(4)]


def test_numbers_of_lines_come_with_the_places(spark):
    """Rows that repeat id and text, null and blank texts, blank first lines; and the result no longer reads the texts."""
    rng = random.Random(1)
    line = " ".join(f"w{rng.randrange(99)}" for _ in range(9))
    rows = [(1, f"\n{line}\n\n x "), (1, f"\n{line}\n\n x "), (1, "other"), (None, line), (None, line), (None, None), (2, ""), (2, None), (3, " \t\n \r"),
            ((1 << 63) - 1, line)]
    docs = frame(spark, rows)
    out = line_neighbours.summary(docs)
    got = sorted(((r.doc_id, r.n_lines, r.n_equal, r.dropped_lines) for r in out.collect()), key=str)
    assert [(i, n) for i, n, _, _ in got] == sorted(((i, sum(bool(x.strip()) for x in (t or "").split("\n"))) for i, t in rows), key=str)
    assert sum(n for _, _, n, _ in got) == 3                 # the line stays in the rows of id 1, and goes in those of the last place
    assert "LogicalRDD" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_words_of_a_line_are_made_once(spark):
    """No filter on the words goes down to where the lines are cut."""
    plans, real = [], line_neighbours.bucketed

    def spy(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *args)

    line_neighbours.bucketed = spy
    try:
        line_neighbours.repeated_lines(frame(spark, [(1, "a b\n\nÄ B"), (2, "ä b")])).count()
    finally:
        line_neighbours.bucketed = real
    assert plans and "Filter" not in plans[0].split("Generate")[0].split("Aggregate")[-1]
