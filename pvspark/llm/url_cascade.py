"""URL rules through a Bloom filter cascade (DataFrame functions only).

``rules`` is a caller-supplied list of (host, path, verdict). A URL fits a rule when its host is the
rule's host or a subdomain of it and its path starts with the rule's path; the longest rule wins.
Every URL therefore has a small set of candidate keys: each suffix of its host (label by label) joined
with each prefix of its path that has the length of some rule path. A candidate is *listed* when it is
a rule. Membership of the candidates is decided by a cascade of Bloom filters instead of a join:

* level 1 encodes the listed keys,
* level 2 encodes the keys of the corpus's whole key universe that pass level 1 without being listed,
* level 3 encodes the listed keys that pass level 2, and so on, until a level has no false positive.

A key is listed exactly if the number of levels it passes before the first miss is odd. That is exact
for every key of the universe the cascade was built over, and the universe is every candidate key of
every URL. Level 1 gets ``log2(universe / listed)`` bits a listed key (times 1.44, with as many hashes
as that needs) so that its false positives number about as many as the listed keys; the filters are thus
bounded by the rule list, which the caller holds in driver memory, not by the corpus.

Defined results: null URL or one without ``://`` has empty host and path, fits no rule and gets the
method's own verdict ``allow``; a rule path longer than the URL's path never fits; repeated rows are
judged one by one; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pvspark.llm.common import LOWER, UPPER, materialise

#: Fixed values of the contract: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

SEP = "\x00"           # between host and path inside a key; neither can hold it after cleaning
WORD = 63              # bits of a filter word that are used (the sign bit stays clear)


@dataclass(frozen=True)
class Level:
    words: tuple[int, ...]
    n_hashes: int
    level: int

    @property
    def bits(self) -> int:
        return len(self.words) * WORD


def host_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def candidates(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Array of keys ``host suffix + SEP + path prefix`` for the given prefix lengths."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_compact(F.array(*[
        F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths]))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit(SEP), p))))))


def _position(key: Column, level: int, h: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.concat(key, F.lit(f"{SEP}{level}.{h}"))), F.lit(bits))


def passes(key: Column, lv: Level) -> Column:
    """True if every bit of ``key`` is set in the level's filter."""
    words = F.array(*[F.lit(w).cast("bigint") for w in lv.words])
    ok = None
    for h in range(lv.n_hashes):
        p = _position(key, lv.level, h, lv.bits)
        hit = F.getbit(F.element_at(words, (F.floor(p / WORD) + 1).cast("int")), (p % WORD).cast("int")) == 1
        ok = hit if ok is None else ok & hit
    return ok


def member(key: Column, levels: list[Level]) -> Column:
    """Listed or not: passing levels 1..i and missing level i+1 means listed for odd i."""
    out = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        out = F.when(passes(key, levels[i]), out).otherwise(F.lit(i % 2 == 1))
    return out


def _filter(keys: DataFrame, n_keys: int, level: int, bits_per_key: float) -> Level:
    """Bloom filter over ``keys.key``; Spark ORs the bits, the driver gets the finished words."""
    n_words = max(1, math.ceil(n_keys * bits_per_key / WORD))
    n_hashes = max(1, round(bits_per_key * math.log(2)))
    pos = keys.select(F.explode(F.array(*[_position(F.col("key"), level, h, n_words * WORD)
                                          for h in range(n_hashes)])).alias("p"))
    got = (pos.groupBy(F.floor(F.col("p") / WORD).alias("w"))
           .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(p % {WORD} as int))")).alias("b")).collect())
    words = [0] * n_words
    for r in got:
        words[r.w] = r.b
    return Level(tuple(words), n_hashes, level)


def build_cascade(universe: DataFrame, listed: list[str], max_levels: int = 64) -> list[Level]:
    """Filters over ``universe(key)`` (distinct keys) for the ``listed`` ones.

    Only listed keys that occur in the universe matter, but all of them go into level 1. Each later level
    rescans the universe; levels shrink by about half, so there are about log2(listed) of them.
    """
    spark = universe.sparkSession
    n_all = universe.count()
    if not listed or not n_all:
        return []
    rows = spark.createDataFrame([(k,) for k in listed], "key string")
    others = universe.filter(~F.col("key").isin(listed))
    n = len(listed)
    levels = [_filter(rows, n, 1, max(2.0, 1.44 * math.log2(max(2, n_all / n))))]
    sides = [rows, others]
    for i in range(2, max_levels + 1):
        # keys of the other side that pass every level so far are this level's content
        side = sides[(i - 1) % 2]
        wrong = side
        for lv in levels:
            wrong = wrong.filter(passes(F.col("key"), lv))
        n_wrong = wrong.count()
        if not n_wrong:
            return levels
        levels.append(_filter(wrong, n_wrong, i, 2.0))
    raise RuntimeError("the cascade did not close; raise max_levels or the bits of its levels")


def judge(pages: DataFrame, rules=RULES, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """One row per page: id, host, path, rule (or null), verdict."""
    lengths = sorted({len(p) for _, p, _ in rules})
    host, path = host_path(F.col(url_col))
    keyed = (pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
             .withColumn("keys", candidates(F.col("host"), F.col("path"), lengths)))
    universe = materialise(keyed.select(F.explode("keys").alias("key")).distinct(), "url-keys")
    levels = build_cascade(universe, [h + SEP + p for h, p, _ in rules])
    hits = F.filter("keys", lambda k: member(k, levels))
    best = F.reduce(hits, F.lit(""), lambda a, k: F.when(F.length(k) > F.length(a), k).otherwise(a))
    verdict = F.create_map(*[F.lit(x) for h, p, v in rules for x in (h + SEP + p, v)])
    return (keyed.withColumn("best", best)
            .select("page_id", "host", "path",
                    F.when(F.col("best") != "", F.replace("best", F.lit(SEP), F.lit(""))).alias("rule"),
                    F.coalesce(F.try_element_at(verdict, F.col("best")), F.lit("allow")).alias("verdict")))
