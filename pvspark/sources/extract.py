"""Raw payload extraction: nested report JSON, label JSON (array-or-string fields), article XML,
forum search results. All JVM-side: ``parse_json`` / variant paths, ``from_json`` with a declared
schema, and ``xpath`` functions - no Python parsing per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pvspark.functions import dates, rules
from pvspark.functions.text import tag_all, tag_first

# Declared report payload schema (subset the extraction reads).
REPORT_PAYLOAD = T.StructType([
    T.StructField("safetyreportid", T.StringType()),
    T.StructField("serious", T.StringType()),
    T.StructField("receivedate", T.StringType()),
    T.StructField("seriousnesshospitalization", T.StringType()),
    T.StructField("seriousnessdeath", T.StringType()),
    T.StructField("seriousnessdisabling", T.StringType()),
    T.StructField("patient", T.StructType([
        T.StructField("drug", T.ArrayType(T.StructType([T.StructField("medicinalproduct", T.StringType())]))),
        T.StructField("reaction", T.ArrayType(T.StructType([T.StructField("reactionmeddrapt", T.StringType())]))),
        T.StructField("patientonsetage", T.StringType()),
        T.StructField("patientweight", T.StringType()),
    ])),
])

REPORT_FLAT = ["report_id", "drug_name", "reaction", "severity", "age", "weight", "report_date",
               "hospitalization", "death", "disability", "ingestion_ts"]


def parse_reports(df: DataFrame, json_col: str = "value") -> DataFrame:
    """JSON text column -> typed payload struct columns (declared schema, never inferred)."""
    return df.select(F.from_json(F.col(json_col), REPORT_PAYLOAD).alias("r")).select("r.*")


def extract_reports(payload: DataFrame, ingestion_ts: Column | None = None) -> DataFrame:
    """Nested report -> 11 flat columns. Only the FIRST drug and FIRST reaction survive
    (reference behaviour); age is a lenient int, weight a lenient double, flags 1 iff == 1."""
    p = F.col("patient")
    return payload.select(
        F.col("safetyreportid").alias("report_id"),
        F.get(p.getField("drug"), 0).getField("medicinalproduct").alias("drug_name"),
        F.get(p.getField("reaction"), 0).getField("reactionmeddrapt").alias("reaction"),
        F.col("serious").alias("severity"),
        rules.lenient_int(p.getField("patientonsetage")).alias("age"),
        p.getField("patientweight").try_cast("double").alias("weight"),
        F.col("receivedate").alias("report_date"),
        rules.flag("seriousnesshospitalization").alias("hospitalization"),
        rules.flag("seriousnessdeath").alias("death"),
        rules.flag("seriousnessdisabling").alias("disability"),
        (ingestion_ts if ingestion_ts is not None else F.current_timestamp()).alias("ingestion_ts"),
    )


def _first_or_default(v: Column, path: str, default: str) -> Column:
    arr = F.try_variant_get(v, path, "array<string>")
    return F.when(F.size(arr) > 0, F.get(arr, 0)).otherwise(F.lit(default))


def _first_text_clip(v: Column, path: str, clip: int | None) -> Column:
    """First element when the field is a non-empty array, the value when it is a string, else
    NULL; clipped to ``clip`` characters (None keeps the full text)."""
    arr = F.try_variant_get(v, path, "array<string>")
    kind = F.schema_of_variant(F.variant_get(v, path, "variant"))
    text = (F.when(arr.isNotNull(), F.get(arr, 0))
            .when(kind == F.lit("STRING"), F.try_variant_get(v, path, "string")))
    return F.substring(text, 1, clip) if clip else text


def label_variant(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Label JSON text -> VARIANT (``v``); malformed text gives NULL (quarantined by rules)."""
    return df.select("*", F.try_parse_json(F.col(json_col)).alias("v"))


def label_openfda_present(v: Column) -> Column:
    """``openfda`` key present and not JSON null (``{}`` passes)."""
    o = F.variant_get(v, "$.openfda", "variant")
    return o.isNotNull() & ~F.is_variant_null(o)


def extract_labels(df: DataFrame, clip: int | None = 500, ingestion_ts: Column | None = None) -> DataFrame:
    """S4 on a frame with a VARIANT column ``v``."""
    v = F.col("v")
    return df.select(
        F.try_variant_get(v, "$.id", "string").alias("drug_id"),
        _first_or_default(v, "$.openfda.brand_name", "unknown").alias("brand_name"),
        _first_or_default(v, "$.openfda.generic_name", "unknown").alias("generic_name"),
        _first_text_clip(v, "$.warnings", clip).alias("warnings"),
        _first_text_clip(v, "$.drug_interactions", clip).alias("interactions"),
        (ingestion_ts if ingestion_ts is not None else F.current_timestamp()).alias("ingestion_ts"),
    )


def _xml_text(x: Column, path: str) -> Column:
    """ElementTree ``find(path).text``: the element's leading text, NULL when absent or empty."""
    return F.nullif(F.xpath_string(x, F.lit(f"{path}/node()[1][self::text()]")), F.lit(""))


def extract_articles(df: DataFrame, xml_col: str = "xml", drug_terms=None) -> DataFrame:
    """One ``PubmedArticle`` XML string per row -> article record (``read_article_sets`` reads
    whole fetches).

    Abstract = non-empty AbstractText parts joined by a space, stripped, NULL when empty.
    ``drug_name`` = first dictionary term found in the title (or ``unknown``).
    """
    from pvspark.functions.text import DRUG_KEYWORDS

    x = F.col(xml_col)
    art = "//PubmedArticle//Article"
    parts = F.xpath(x, F.lit(f"{art}/Abstract/AbstractText/node()[1][self::text()]"))
    joined = F.array_join(F.filter(parts, lambda p: p != F.lit("")), " ")
    pd_ = f"{art}/Journal/JournalIssue/PubDate"
    # the six parts are extracted once and then used: an XPath evaluation parses the document
    found = df.select(
        _xml_text(x, "//PubmedArticle//MedlineCitation/PMID").alias("article_id"),
        _xml_text(x, f"{art}/ArticleTitle").alias("title"), joined.alias("joined"),
        _xml_text(x, f"{pd_}/Year").alias("year"), _xml_text(x, f"{pd_}/Month").alias("month"),
        _xml_text(x, f"{pd_}/MedlineDate").alias("medline"))
    out = found.select(
        "article_id", "title", F.nullif(F.regexp_replace("joined", r"^\s+|\s+$", ""), F.lit("")).alias("abstract"),
        dates.pub_date(F.col("year"), F.col("month"), F.col("medline")).alias("publish_date"))
    return _named(out, drug_terms if drug_terms is not None else DRUG_KEYWORDS)


def _named(articles: DataFrame, terms) -> DataFrame:
    """``drug_name``, the first dictionary term in the title."""
    if isinstance(terms, Column):
        return articles.withColumn("_terms", terms).withColumn("drug_name", tag_first(F.col("title"), F.col("_terms"))).drop("_terms")
    return articles.withColumn("drug_name", tag_first(F.col("title"), terms))


_ARTICLE = ("struct<PMID:string,Article:struct<Journal:struct<JournalIssue:struct<PubDate:struct<Year:string,Month:string,"
            "MedlineDate:string>>>,ArticleTitle:string,Abstract:struct<AbstractText:array<string>>>>")
BROKEN_SET = "article set is not well-formed"


def _leading(x: Column) -> Column:
    """Leading text of an element that the reader gives as markup: what stands before its first child element, NULL when
    empty. A ``<`` that no element follows is text."""
    child = r"(?s)^(.*?)(?:<([A-Za-z][\w:.-]*)(?:\s[^<>]*)?(?:/>|>.*?</\2\s*>)|$)"
    return F.nullif(F.when(F.contains(x, F.lit("<")), F.regexp_extract(x, child, 1)).otherwise(x), F.lit(""))


def read_article_sets(spark, path: str, drug_terms=None) -> tuple[DataFrame, DataFrame]:
    """S5 / S6 / J9 for whole fetches: XML files with any number of ``PubmedArticle`` elements -> (articles, broken).

    The reader splits a file at the elements, so no file is held as one value. An article directly inside another one is an
    article too. ``broken`` has a row (file, reason) for each file that stops being well-formed: its articles up to there
    are kept, what follows is not read.
    """
    from pvspark.functions.text import DRUG_KEYWORDS

    schema = f"MedlineCitation {_ARTICLE}, PubmedArticle array<struct<MedlineCitation:{_ARTICLE}>>, _corrupt string"
    sets = (spark.read.format("xml").option("rowTag", "PubmedArticle").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt").option("ignoreSurroundingSpaces", "false").schema(schema).load(path))
    broken = (sets.filter(F.col("_corrupt").isNotNull() & F.col("MedlineCitation").isNull())
              .select(F.col("_metadata.file_path").alias("file"), F.lit(BROKEN_SET).alias("reason")).distinct())
    inner = F.transform(F.coalesce("PubmedArticle", F.array().cast(f"array<struct<MedlineCitation:{_ARTICLE}>>")), lambda a: a["MedlineCitation"])
    each = (sets.filter(F.col("_corrupt").isNull())
            .select(F.explode(F.concat(F.array("MedlineCitation"), inner)).alias("c")).select(F.col("c.PMID").alias("id"), "c.Article.*"))
    date = F.col("Journal.JournalIssue.PubDate")
    parts = F.transform(F.col("Abstract.AbstractText"), _leading)
    joined = F.array_join(F.filter(parts, lambda p: p.isNotNull()), " ")
    out = each.select(
        _leading(F.col("id")).alias("article_id"), _leading(F.col("ArticleTitle")).alias("title"),
        F.nullif(F.regexp_replace(joined, r"^\s+|\s+$", ""), F.lit("")).alias("abstract"),
        dates.pub_date(_leading(date["Year"]), _leading(date["Month"]), _leading(date["MedlineDate"])).alias("publish_date"))
    return _named(out, drug_terms if drug_terms is not None else DRUG_KEYWORDS), broken


FORUM_PAYLOAD = T.StructType([T.StructField("data", T.StructType([
    T.StructField("id", T.StringType()), T.StructField("subreddit", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("selftext", T.StringType()),
    T.StructField("body", T.StringType()), T.StructField("score", T.IntegerType()),
    T.StructField("created_utc", T.DoubleType())]))])


def posts_from_search(df: DataFrame, kind: str, drug_terms=None, ingestion_ts: Column | None = None) -> DataFrame:
    """Forum search children (``data`` struct) -> post records. ``kind='post'`` reads
    title + selftext, ``kind='comment'`` has an empty title and reads ``body``; epoch -> UTC
    timestamp; ``drug_mentions`` by the all-matches tagger over title + body."""
    from pvspark.functions.text import DRUG_KEYWORDS

    d = F.col("data")
    if kind == "post":
        title, body = F.coalesce(d.getField("title"), F.lit("")), F.coalesce(d.getField("selftext"), F.lit(""))
    elif kind == "comment":
        title, body = F.lit(""), F.coalesce(d.getField("body"), F.lit(""))
    else:
        raise ValueError(kind)
    extra = [c for c in df.columns if c != "data"]
    out = df.select(
        *extra,
        d.getField("id").alias("post_id"), d.getField("subreddit").alias("subreddit"),
        title.alias("title"), body.alias("body"), d.getField("score").alias("score"),
        dates.iso_from_epoch(d.getField("created_utc")).alias("created_utc"),
        (ingestion_ts if ingestion_ts is not None else F.current_timestamp()).alias("ingestion_ts"),
        F.lit(kind).alias("kind"))
    terms = drug_terms if drug_terms is not None else DRUG_KEYWORDS
    if isinstance(terms, Column):
        out = out.withColumn("_terms", terms)
        terms = F.col("_terms")
    out = out.withColumn("drug_mentions", tag_all(F.concat_ws(" ", "title", "body"), terms))
    return out.drop("_terms") if "_terms" in out.columns else out
