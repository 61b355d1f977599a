"""Dictionary matching on text columns: contains-any, all-matches tagging, first-match tagging.

A Python list of terms (a fixed vocabulary that the caller holds) is inlined as a literal array;
matching is case-insensitive substring containment, evaluated JVM-side by the ``filter`` /
``exists`` higher-order functions: no Python worker, no join. A dictionary TABLE of any size is
matched by ``match_dictionary``, a join on n-grams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's behaviour -------------------------------
# Drug keywords for tagging posts and article titles, in dictionary order.
DRUG_KEYWORDS = ["Adderall", "Oxycodone", "Xanax", "Metformin", "Lisinopril",
                 "Atorvastatin", "Ibuprofen", "Amoxicillin", "Methadone", "Fentanyl"]
# Terms counted in the dependency / withdrawal mention rates.
DEPENDENCY_TERMS = ["addicted", "addiction", "dependent", "dependence", "habit", "hooked"]
WITHDRAWAL_TERMS = ["withdrawal", "withdrawing", "cold turkey", "stopped taking", "quitting"]
# Terms that make an abstract count towards the negative research consensus.
NEGATIVE_RESEARCH_TERMS = ["risk", "adverse", "danger", "toxic", "harmful", "fatal"]
# Forums searched and allowed by the posts suite.
SUBREDDITS = ["AskDocs", "pharmacy", "drugnerds", "Nootropics", "ChronicPain", "addiction",
              "mentalhealth"]
# Safety phrases searched in each forum.
SAFETY_TERMS = ["side effects", "adverse reaction", "overdose", "withdrawal", "drug interaction",
                "stopped taking", "started taking"]
UNKNOWN = "unknown"
# ------------------------------------------------------------------------------------------

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _terms(terms) -> Column:
    """Terms as ``array<struct<t: original, l: lower-cased>>``, lower-casing done once (at plan
    time for literal lists, once per query for a dictionary subquery)."""
    if isinstance(terms, Column):
        return terms
    terms = list(terms)
    if not terms:
        return F.array().cast("array<struct<t:string,l:string>>")
    return F.array(*[F.struct(F.lit(t).alias("t"), F.lit(t.lower()).alias("l")) for t in terms])


def _with_hay(text, fn) -> Column:
    """Evaluate ``lower(text)`` ONCE per row and hand it to ``fn`` as a lambda variable (a
    reference to an outer expression inside a lambda would be re-evaluated per term)."""
    hay = F.lower(F.coalesce(_c(text), F.lit("")))
    return F.get(F.transform(F.array(hay), fn), 0)


def contains_any(text, terms: Sequence[str] | Column) -> Column:
    """True iff lower(text) contains any term (lower-cased); null text -> False."""
    ts = _terms(terms)
    return _with_hay(text, lambda h: F.exists(ts, lambda k: F.contains(h, k["l"])))


def matches(text, terms: Sequence[str] | Column) -> Column:
    """All terms contained in the text, in dictionary order (original spelling)."""
    ts = _terms(terms)
    return _with_hay(text, lambda h: F.transform(F.filter(ts, lambda k: F.contains(h, k["l"])), lambda k: k["t"]))


def tag_all(text, terms: Sequence[str] | Column) -> Column:
    """CSV of every matching term in dictionary order, else ``unknown``."""
    m = matches(text, terms)
    return F.when(F.size(m) == 0, F.lit(UNKNOWN)).otherwise(F.array_join(m, ","))


def tag_first(text, terms: Sequence[str] | Column) -> Column:
    """First matching term in dictionary order; empty / null text or no match -> ``unknown``."""
    t = _c(text)
    first = F.get(matches(t, terms), 0)
    return F.when(t.isNull() | (t == F.lit("")), F.lit(UNKNOWN)).otherwise(F.coalesce(first, F.lit(UNKNOWN)))


GRAM = 4            # characters of a key of the dictionary join; shorter terms are their own key
LONG = 6            # characters of the key of a term that has as many: far fewer terms share it
PIECE = 256         # characters of a text that are cut into grams at once (cutting is linear in the text then)
BITS = 63           # used bits of a filter word
KEY_BITS = 16       # filter bits for a key
FILTER_WORDS = 1 << 15      # at most 256 KB of filter; with more keys it lets more grams pass, none less


def _grams(text: Column, n: int) -> Column:
    """Distinct n-grams of a text (none for shorter texts)."""
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, F.lit(n))))
    ).otherwise(F.array().cast("array<string>"))


def _bit(gram: Column, words: Column) -> tuple[Column, Column]:
    """Filter word and bit of a gram."""
    at = F.pmod(F.xxhash64(gram), words * BITS)
    return F.floor(at / BITS).cast("int"), (at % BITS).cast("int")


def _gram_filter(keys: DataFrame) -> tuple[Column, Column]:
    """The filter over ``keys(g)`` as two scalars: an array of words, and their number. Spark builds the bits with one
    aggregation a word; its size follows the number of keys up to FILTER_WORDS."""
    words = keys.agg(F.least(F.lit(FILTER_WORDS), F.ceil((F.count(F.lit(1)) + 1) * KEY_BITS / BITS)).cast("int")).scalar()
    word, bit = _bit(F.col("g"), words)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    none = F.explode(F.sequence(F.lit(0), words - 1))
    full = (keys.select(word.alias("w"), one.alias("b"))
            .unionByName(keys.sparkSession.range(1).select(none.alias("w"), F.lit(0).cast("bigint").alias("b")))
            .groupBy("w").agg(F.bit_or("b").alias("b")))
    bits = full.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"])).scalar()
    return bits, words


def match_dictionary(df: DataFrame, text: Column, dictionary: DataFrame, col: str = "term", out: str = "terms") -> DataFrame:
    """J6 / J8 for a dictionary table of any size: ``df`` plus ``out``, the array of all terms that the text contains
    (case-insensitively), in the terms' order; null for a text without a match.

    Each term is keyed by its rarest n-gram in the dictionary. Texts are cut into grams of the lengths that keys have, and a
    filter of the keys' own grams is tested before a gram leaves its row, so only grams that are (very likely) keys
    are shuffled, as hashes, with the hash of their text. An equi-join brings candidate terms together, and ``contains`` decides where
    the text is. A frequent gram is split by Spark's skew-join handling; nothing of the texts is broadcast or collected.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    rows = df.withColumns({"__hay": low, "__h": F.xxhash64(low)})
    found = _candidates(rows, dictionary, col).groupBy("__h").agg(F.collect_set("t").alias("__c"))
    hit = F.array_sort(F.filter("__c", lambda c: F.contains("__hay", F.lower(c))))
    joined = rows.join(found, "__h", "left").withColumn(out, hit)
    return joined.withColumn(out, F.when(F.size(out) > 0, F.col(out))).drop("__h", "__hay", "__c")


def _candidates(rows: DataFrame, dictionary: DataFrame, col: str) -> DataFrame:
    """(__h, t): the terms that a text (``__hay``, its hash ``__h``) may contain; none that it contains is left out."""
    terms = (dictionary.select(F.col(col).alias("t")).filter("t is not null and t != ''").distinct()
             .withColumn("l", F.lower("t")))
    own = F.when(F.length("l") < GRAM, F.array("l")).when(F.length("l") < LONG, _grams(F.col("l"), GRAM)).otherwise(_grams(F.col("l"), LONG))
    grams = terms.select("t", F.explode(own).alias("g"))
    rarity = grams.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    keyed = grams.join(rarity, "g").groupBy("t").agg(F.min(F.struct("n", "g")).alias("k")).select("t", F.col("k.g").alias("g"))
    keys = keyed.select("g").distinct()
    bits, words = _gram_filter(keys)
    lengths = keys.agg(F.coalesce(F.collect_set(F.length("g")), F.array().cast("array<int>"))).scalar()
    pieces = (rows.select("__h", "__hay", F.explode(F.sequence(F.lit(1), F.greatest(F.length("__hay"), F.lit(1)), F.lit(PIECE))).alias("p"))
              .select("__h", F.substr("__hay", F.col("p"), F.lit(PIECE + LONG - 1)).alias("piece")))
    cut = (pieces.select("__h", "piece", F.explode(lengths).alias("n"))
           .select("__h", "piece", "n", F.explode(F.sequence(F.lit(1), F.least(
               F.lit(PIECE), F.greatest(F.length("piece") - F.col("n") + 1, F.lit(1))))).alias("i"))
           .filter(F.col("i") + F.col("n") - 1 <= F.length("piece")).select("__h", F.substr("piece", F.col("i"), F.col("n")).alias("g")))
    word, bit = _bit(F.col("g"), words)
    known = F.call_function("shiftright", F.get(bits, word), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return cut.filter(known).select("__h", F.hash("g").alias("k")).distinct().join(keyed.select("t", F.hash("g").alias("k")), "k").select("__h", "t")


def tag_dictionary(df: DataFrame, text: Column, dictionary: DataFrame, col: str = "term", out: str = "drug_mentions") -> DataFrame:
    """J8 with a dictionary table: CSV of every matching term in the terms' order, else ``unknown``."""
    return (match_dictionary(df, text, dictionary, col, "__terms")
            .withColumn(out, F.coalesce(F.array_join("__terms", ","), F.lit(UNKNOWN))).drop("__terms"))
