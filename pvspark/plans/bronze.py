"""Build step 4: payload extraction, bronze validity rules, taggers, union, most-recent-N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pvspark.functions import dates, text
from pvspark.operators import validate
from pvspark.plans.base import int_guard, register, round_doubles
from pvspark.sources import extract, fixtures
from pvspark.sources.tables import read_table

# ---- payload builders: driver rows -> the nested shapes the sources deliver ---------------


def report_payload_json(raw: DataFrame) -> DataFrame:
    """reports_raw -> one report JSON document per row (``value``). A second drug / reaction is
    appended so that the first-element rule is exercised; a NULL reaction gives an empty list."""
    drug = F.array(F.struct(F.col("drug_name").alias("medicinalproduct")),
                   F.struct(F.lit("SECOND DRUG").alias("medicinalproduct")))
    reac = F.when(F.col("reaction").isNull(), F.array().cast("array<struct<reactionmeddrapt:string>>")).otherwise(
        F.array(F.struct(F.col("reaction").alias("reactionmeddrapt")),
                F.struct(F.lit("second reaction").alias("reactionmeddrapt"))))
    doc = F.struct(
        F.col("report_id").alias("safetyreportid"), F.col("severity").alias("serious"),
        F.col("report_date").alias("receivedate"),
        F.col("hospitalization").alias("seriousnesshospitalization"),
        F.col("death").alias("seriousnessdeath"), F.col("disability").alias("seriousnessdisabling"),
        F.struct(drug.alias("drug"), reac.alias("reaction"), F.col("age").alias("patientonsetage"),
                 F.col("weight").alias("patientweight")).alias("patient"))
    return raw.select(F.to_json(doc).alias("value"))


def _json_str(c: Column) -> Column:
    """A JSON string literal for ``c`` (quoted and escaped)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def label_payload_json(raw: DataFrame) -> DataFrame:
    """labels_raw (+ p_partkey) -> label JSON. Names as lists (empty when ``unknown``), texts
    alternately as a list and as a plain string, ``openfda`` JSON null for every 37th label."""
    key = F.col("drug_id").cast("long")

    def names(c: str) -> Column:
        return F.when(F.col(c) == "unknown", F.array().cast("array<string>")).otherwise(F.array(F.col(c), F.lit("alt")))

    def text_field(c: str) -> Column:
        return (F.when(F.col(c).isNull(), F.lit("null"))
                .when(key % 2 == 0, F.to_json(F.array(F.col(c))))
                .otherwise(_json_str(F.col(c))))

    openfda = F.when(key % 37 == 0, F.lit("null")).otherwise(
        F.to_json(F.struct(names("brand_name").alias("brand_name"), names("generic_name").alias("generic_name"))))
    # a day of 2000 to 2024; every 41st label has none
    day = F.when(key % 41 == 0, F.lit("null")).otherwise(F.concat(
        F.lit('"'), (2000 + key * 7 % 25).cast("string"), F.lpad((1 + key % 12).cast("string"), 2, "0"), F.lit('15"')))
    doc = F.concat(F.lit('{"id":'), _json_str(F.col("drug_id")), F.lit(',"effective_time":'), day, F.lit(',"openfda":'), openfda,
                   F.lit(',"warnings":'), text_field("warnings"),
                   F.lit(',"drug_interactions":'), text_field("interactions"), F.lit("}"))
    return raw.select(doc.alias("value"))


def _xml_escape(c: Column) -> Column:
    c = F.regexp_replace(c, "[\\x00-\\x08\\x0B\\x0C\\x0D\\x0E-\\x1F]", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


MONTH_NAMES = list(dates.MONTHS)


def article_xml(docs: DataFrame, keep: str | None = None) -> DataFrame:
    """documents -> one PubmedArticle XML string per document. Lines of the text become
    AbstractText parts; the PubDate form rotates over Year+Month name, Year+number, Year only,
    a MedlineDate range and a season MedlineDate (no year)."""
    did = F.col("doc_id")
    year = (F.lit(1990) + did % 35).cast("string")
    mnum = (F.lit(1) + did % 12).cast("int")
    month_name = F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), mnum)
    month_txt = F.when(did % 29 == 0, F.lit("13")).when(did % 5 == 0, month_name).otherwise(mnum.cast("string"))
    form = did % 5
    pubdate = (F.when(form <= 1, F.concat(F.lit("<Year>"), year, F.lit("</Year><Month>"), month_txt, F.lit("</Month>")))
               .when(form == 2, F.concat(F.lit("<Year>"), year, F.lit("</Year>")))
               .when(form == 3, F.concat(F.lit("<MedlineDate>"), year, F.lit(" Dec-"),
                                         (F.lit(1991) + did % 35).cast("string"), F.lit(" Jan</MedlineDate>")))
               .otherwise(F.concat(F.lit("<MedlineDate>Spring "), year, F.lit("</MedlineDate>"))))
    parts = F.transform(F.split(F.col("text"), "\n"),
                        lambda p: F.concat(F.lit("<AbstractText>"), _xml_escape(p), F.lit("</AbstractText>")))
    xml = F.concat(
        F.lit("<PubmedArticle><MedlineCitation><PMID>"), did.cast("string"), F.lit("</PMID><Article><ArticleTitle>"),
        _xml_escape(F.split_part(F.col("text"), F.lit("\n"), F.lit(1))), F.lit("</ArticleTitle><Abstract>"), F.array_join(parts, ""),
        F.lit("</Abstract><Journal><JournalIssue><PubDate>"), pubdate,
        F.lit("</PubDate></JournalIssue></Journal></Article></MedlineCitation></PubmedArticle>"))
    return docs.select(*([keep] if keep else []), xml.alias("xml"))


def forum_payload(base: DataFrame) -> DataFrame:
    """posts_base -> forum search children (``data`` struct) plus an arrival sequence.
    Even events are posts (title + selftext), odd events comments (body); every 43rd id is null."""
    seq = F.col("tie1")
    epoch = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                             F.col("created_utc")) / F.lit(1_000_000.0)
    pid = F.when(seq % 43 == 0, F.lit(None).cast("string")).otherwise(F.col("post_id"))
    is_post = seq % 2 == 0
    data = F.struct(pid.alias("id"), F.col("subreddit").alias("subreddit"),
                    F.when(is_post, F.col("title")).alias("title"),
                    F.when(is_post, F.col("body")).alias("selftext"),
                    F.when(~is_post, F.col("body")).alias("body"),
                    F.col("score").alias("score"), epoch.alias("created_utc"))
    return base.select(data.alias("data"), seq.alias("seq"), is_post.alias("is_post"))


# ---- queries --------------------------------------------------------------------------------

def _flag_sql(c: str) -> str:
    return f"(CASE WHEN {int_guard(c)} = 1 THEN 1 ELSE 0 END)"


@register("extract_reports", fixtures.oracle_ctes("reports_raw") + f"""
SELECT report_id, drug_name, reaction, severity, {int_guard('age')} AS age,
       round(TRY_CAST(weight AS DOUBLE), 6) AS weight, report_date,
       {_flag_sql('hospitalization')} AS hospitalization, {_flag_sql('death')} AS death,
       {_flag_sql('disability')} AS disability
FROM reports_raw""")
def q_extract_reports(spark, sf_dir):
    payload = extract.parse_reports(report_payload_json(fixtures.reports_raw(spark, sf_dir)))
    return round_doubles(extract.extract_reports(payload).drop("ingestion_ts"))


@register("extract_labels", fixtures.oracle_ctes("labels_raw") + """
SELECT drug_id, brand_name, generic_name, substr(warnings, 1, 500) AS warnings,
       substr(interactions, 1, 500) AS interactions
FROM labels_raw WHERE CAST(drug_id AS BIGINT) % 37 <> 0""")
def q_extract_labels(spark, sf_dir):
    v = extract.label_variant(label_payload_json(fixtures.labels_raw(spark, sf_dir)))
    valid, _ = validate.split_valid(v.withColumn("drug_id", F.try_variant_get("v", "$.id", "string")),
                                    validate.label_rules(extract.label_openfda_present(F.col("v"))))
    return extract.extract_labels(valid, clip=500).drop("ingestion_ts")


@register("latest_labels", fixtures.oracle_ctes("labels_raw") + """,
newest AS (SELECT *, CASE WHEN CAST(drug_id AS BIGINT) % 41 <> 0 THEN CAST(2000 + CAST(drug_id AS BIGINT) * 7 % 25 AS VARCHAR)
                       || lpad(CAST(1 + CAST(drug_id AS BIGINT) % 12 AS VARCHAR), 2, '0') || '15' END AS day
           FROM labels_raw ORDER BY day DESC NULLS LAST, drug_id LIMIT 100)
SELECT drug_id, brand_name, generic_name, substr(warnings, 1, 500) AS warnings,
       substr(interactions, 1, 500) AS interactions
FROM newest WHERE CAST(drug_id AS BIGINT) % 37 <> 0""")
def q_latest_labels(spark, sf_dir):
    """S7 + P16 + S4: the 100 newest label payloads by effective day (the limit is the feature), then validated and extracted."""
    from pvspark.operators.posts import newest_labels
    v = newest_labels(extract.label_variant(label_payload_json(fixtures.labels_raw(spark, sf_dir))), 100)
    valid, _ = validate.split_valid(v.withColumn("drug_id", F.try_variant_get("v", "$.id", "string")),
                                    validate.label_rules(extract.label_openfda_present(F.col("v"))))
    return extract.extract_labels(valid, clip=500).drop("ingestion_ts")


_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
_XML_CLEAN = "regexp_replace({x}, '[\\x00-\\x08\\x0B\\x0C\\x0D\\x0E-\\x1F]', '', 'g')"


def _pub_date_sql() -> str:
    y = "CAST(1990 + doc_id % 35 AS VARCHAR)"
    mm = "lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0')"
    return (f"CASE WHEN doc_id % 5 <= 1 THEN {y} || '-' || (CASE WHEN doc_id % 29 = 0 THEN '13' ELSE {mm} END) || '-01' "
            f"WHEN doc_id % 5 <= 3 THEN {y} || '-01-01' END")


@register("extract_articles", f"""
SELECT CAST(doc_id AS VARCHAR) AS article_id,
       nullif({_STRIP.format(x="array_to_string(list_filter(string_split(" + _XML_CLEAN.format(x='text') + ", chr(10)), lambda p: p <> ''), ' ')")}, '') AS abstract,
       {_pub_date_sql()} AS publish_date,
       'unknown' AS drug_name
FROM documents""")
def q_extract_articles(spark, sf_dir):
    """S5 + S6 + J9 on generated PubmedArticle XML; ``drug_name`` uses the fixed drug keywords."""
    from pvspark.sources.tables import read_table
    a = extract.extract_articles(article_xml(read_table(spark, sf_dir, "documents")))
    return a.select("article_id", "abstract", "publish_date", "drug_name")


SET_SIZE = 100              # articles of a fetch
BREAKS = 4                  # every fourth set ends inside its last article


def article_sets(docs: DataFrame) -> DataFrame:
    """documents -> fetches of up to SET_SIZE articles: (set, value), one XML document a row. Titles carry a drug keyword
    (2 of 5) or markup (2 of 11), every seventh article's first abstract part goes on after a child element, every
    17th article holds another one, and every fourth set is cut off inside its last article."""
    did = F.col("doc_id")
    keyword = F.element_at(F.array(*[F.lit(t) for t in text.DRUG_KEYWORDS]), (did % len(text.DRUG_KEYWORDS) + 1).cast("int"))
    head = F.when(did % 5 < 2, F.concat(keyword, F.lit(" "))).otherwise(F.lit(""))
    mark = (F.when(did % 11 == 0, F.lit("<i>first</i> ")).when(did % 11 == 1, F.concat(head, F.lit("x &lt; y <b>bold</b> ")))
            .otherwise(head))
    xml = F.col("xml")
    for at, more in (("<ArticleTitle>", mark),
                     ("<AbstractText>", F.when(did % 7 == 0, F.lit("lead <sup>2</sup> ")).otherwise(F.lit("")))):
        place = F.locate(at, xml) + len(at)
        xml = F.concat(F.left(xml, place - 1), more, F.substring(xml, place, F.length(xml)))
    inside = F.concat(F.lit("<PubmedArticle><MedlineCitation><PMID>"), did.cast("string"),
                      F.lit("n</PMID><Article><ArticleTitle>held</ArticleTitle></Article></MedlineCitation></PubmedArticle></PubmedArticle>"))
    end = len("</PubmedArticle>")
    xml = F.when(did % 17 == 0, F.concat(F.substring(xml, F.lit(1), F.length(xml) - end), inside)).otherwise(xml)
    rows = article_xml(docs, keep="doc_id").select("doc_id", xml.alias("xml"), F.floor(did / SET_SIZE).alias("set"))
    sets = rows.groupBy("set").agg(F.sort_array(F.collect_list(F.struct("doc_id", "xml"))).alias("a"))
    body = F.array_join(F.transform("a", lambda a: a["xml"]), "")
    # without the last article's end and the set's end
    cut = F.col("set") % BREAKS == 1
    value = F.when(cut, F.substring(body, F.lit(1), F.length(body) - 2 * end)).otherwise(F.concat(body, F.lit("</PubmedArticleSet>")))
    return sets.select("set", F.concat(F.lit("<PubmedArticleSet>"), value).alias("value"))


_SET_TITLE = f"""CASE WHEN doc_id % 11 = 0 THEN NULL ELSE nullif((CASE WHEN doc_id % 5 < 2 THEN kw[CAST(doc_id % len(kw) AS BIGINT) + 1] || ' ' ELSE '' END)
  || (CASE WHEN doc_id % 11 = 1 THEN 'x < y ' ELSE split_part({_XML_CLEAN.format(x='text')}, chr(10), 1) END), '') END"""


@register("articles_from_set", f"""
WITH k AS (SELECT [{', '.join(f"'{t}'" for t in text.DRUG_KEYWORDS)}] AS kw),
s AS (SELECT *, doc_id // {SET_SIZE} AS grp, doc_id = max(doc_id) OVER (PARTITION BY doc_id // {SET_SIZE}) AND doc_id // {SET_SIZE} % {BREAKS} = 1 AS lost
      FROM documents, k),
a AS (SELECT doc_id, {_SET_TITLE} AS title, kw,
             CASE WHEN doc_id % 7 = 0 THEN list_concat(['lead '], string_split({_XML_CLEAN.format(x='text')}, chr(10))[2:])
                  ELSE string_split({_XML_CLEAN.format(x='text')}, chr(10)) END AS parts FROM s WHERE NOT lost)
SELECT CAST(doc_id AS VARCHAR) AS article_id, title,
       nullif({_STRIP.format(x="array_to_string(list_filter(parts, lambda p: p <> ''), ' ')")}, '') AS abstract, {_pub_date_sql()} AS publish_date,
       CASE WHEN title IS NULL OR title = '' THEN 'unknown' ELSE coalesce(list_filter(kw, lambda t: contains(lower(title), lower(t)))[1], 'unknown') END
         AS drug_name, NULL::VARCHAR AS reason FROM a
UNION ALL SELECT CAST(doc_id AS VARCHAR) || 'n', 'held', NULL, NULL, 'unknown', NULL FROM s WHERE doc_id % 17 = 0 AND NOT lost
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, '{extract.BROKEN_SET}' FROM (SELECT DISTINCT grp FROM s WHERE lost)""")
def q_articles_from_set(spark, sf_dir):
    """S5 for whole fetches: XML files of many articles through the row source, with markup in titles and abstracts, nested
    articles, and broken files in quarantine."""
    import uuid

    from pvspark.session import scratch_path
    from pvspark.sources.tables import read_table
    path = scratch_path(spark, f"article-sets-{uuid.uuid4().hex}")
    article_sets(read_table(spark, sf_dir, "documents")).write.partitionBy("set").text(path)
    found, broken = extract.read_article_sets(spark, f"{path}/set=*")
    none = F.lit(None).cast("string")
    return found.withColumn("reason", none).unionByName(broken.select(
        *[none.alias(c) for c in ("article_id", "title", "abstract")], F.lit(None).cast(found.schema["publish_date"].dataType).alias("publish_date"),
        none.alias("drug_name"), "reason"))


@register("pub_date", f"SELECT CAST(doc_id AS VARCHAR) AS article_id, {_pub_date_sql()} AS publish_date FROM documents")
def q_pub_date(spark, sf_dir):
    """S6 alone on (Year, Month, MedlineDate) text columns derived from each document id."""
    from pvspark.sources.tables import read_table
    d = read_table(spark, sf_dir, "documents").select("doc_id")
    did = F.col("doc_id")
    year = (F.lit(1990) + did % 35).cast("string")
    mnum = (F.lit(1) + did % 12).cast("int")
    form = did % 5
    name = F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), mnum)
    month = F.when(form <= 1, F.when(did % 29 == 0, F.lit("13")).when(form == 0, name).otherwise(mnum.cast("string")))
    y = F.when(form <= 2, year)
    medline = (F.when(form == 3, F.concat(year, F.lit(" Dec-"), (F.lit(1991) + did % 35).cast("string"), F.lit(" Jan")))
               .when(form == 4, F.concat(F.lit("Spring "), year)))
    return d.select(did.cast("string").alias("article_id"), dates.pub_date(y, month, medline).alias("publish_date"))


_REJECTS_ORACLE = fixtures.oracle_ctes("reports_raw", "posts_raw", "articles_raw", "labels_raw") + """
, r AS (
  SELECT 'reports' AS source, CASE WHEN report_id IS NULL OR report_id = '' THEN 'missing report_id'
      WHEN drug_name IS NULL OR drug_name = '' THEN 'missing drug_name'
      WHEN severity IS NULL OR severity NOT IN ('1', '2') THEN 'invalid severity' ELSE 'kept' END AS reason
  FROM reports_raw
  UNION ALL
  SELECT 'posts', CASE WHEN post_id IS NULL OR post_id = '' THEN 'post_id is null'
      WHEN body IS NULL OR body = '' THEN 'body is null or empty'
      WHEN created_utc IS NULL THEN 'created_utc is null' ELSE 'kept' END FROM posts_raw
  UNION ALL
  SELECT 'articles', CASE WHEN article_id IS NULL OR article_id = '' THEN 'missing article_id'
      WHEN title IS NULL OR title = '' THEN 'missing title'
      WHEN abstract IS NULL OR abstract = '' THEN 'missing abstract' ELSE 'kept' END FROM articles_raw
  UNION ALL
  SELECT 'labels', CASE WHEN drug_id IS NULL OR drug_id = '' THEN 'missing id'
      WHEN CAST(drug_id AS BIGINT) % 37 = 0 THEN 'missing openfda' ELSE 'kept' END FROM labels_raw
)
SELECT source, reason, count(*) AS n FROM r GROUP BY source, reason"""


@register("reject_counts", _REJECTS_ORACLE)
def q_reject_counts(spark, sf_dir):
    """First failing rule per record, counted per (source, reason)."""
    rep = validate.tag(fixtures.reports_raw(spark, sf_dir), validate.report_rules())
    pst = validate.tag(fixtures.posts_raw(spark, sf_dir), validate.post_rules())
    art = validate.tag(fixtures.articles_raw(spark, sf_dir), validate.article_rules())
    v = extract.label_variant(label_payload_json(fixtures.labels_raw(spark, sf_dir)))
    v = v.withColumn("drug_id", F.try_variant_get("v", "$.id", "string"))
    lab = validate.tag(v, validate.label_rules(extract.label_openfda_present(F.col("v"))))
    out = validate.reject_counts(rep, "reports")
    for df, src in ((pst, "posts"), (art, "articles"), (lab, "labels")):
        out = out.unionByName(validate.reject_counts(df, src))
    return out


@register("tag_all_keywords", fixtures.oracle_ctes("posts_raw") + "\nSELECT tie1 AS event_id, drug_mentions FROM posts_raw")
def q_tag_all_keywords(spark, sf_dir):
    """J8 with a dictionary table (distinct part names), by the n-gram join."""
    return fixtures.posts_raw(spark, sf_dir).select(F.col("tie1").alias("event_id"), "drug_mentions")


@register("tag_large_dictionary", """
WITH w AS (SELECT DISTINCT unnest(string_split(lower(replace(text, chr(10), ' ')), ' ')) AS term FROM documents),
d AS (SELECT term FROM w WHERE length(term) >= 9),
m AS (SELECT b.item_id, count(*) AS n, string_agg(d.term, ',' ORDER BY d.term) AS terms
      FROM benchmark b JOIN d ON contains(lower(b.text), d.term) GROUP BY b.item_id)
SELECT item_id, (SELECT count(*) FROM d) > 10000 AS large, coalesce(n, 0) AS n_terms, md5(coalesce(terms, '')) AS terms_md5
FROM benchmark LEFT JOIN m USING (item_id)""")
def q_tag_large_dictionary(spark, sf_dir):
    """J6 / J8 beyond any literal list: every benchmark passage tagged with all long words of the documents."""
    words = (read_table(spark, sf_dir, "documents")
             .select(F.explode(F.split(F.lower(F.replace("text", F.lit("\n"), F.lit(" "))), " ")).alias("term"))
             .filter(F.length("term") >= 9).distinct())
    hits = text.match_dictionary(read_table(spark, sf_dir, "benchmark"), F.col("text"), words)
    large = words.agg(F.count(F.lit(1)) > 10000).scalar()
    return hits.select("item_id", large.alias("large"), F.coalesce(F.size("terms"), F.lit(0)).cast("bigint").alias("n_terms"),
                       F.md5(F.coalesce(F.array_join("terms", ","), F.lit(""))).alias("terms_md5"))


# Test vocabulary for first-match tagging over article titles (frequent tokens of the prose).
TITLE_TERMS = ["Adderall", "the", "de", "der", "and"]
_TITLE_LIST = "[" + ", ".join(f"'{t}'" for t in TITLE_TERMS) + "]"


@register("tag_first_keyword", fixtures.oracle_ctes("articles_raw") + f"""
SELECT article_id, CASE WHEN title IS NULL OR title = '' THEN 'unknown'
  ELSE coalesce(list_filter({_TITLE_LIST}, lambda k: contains(lower(title), lower(k)))[1], 'unknown') END AS drug_name
FROM articles_raw""")
def q_tag_first_keyword(spark, sf_dir):
    a = fixtures.articles_raw(spark, sf_dir)
    return a.select("article_id", text.tag_first("title", TITLE_TERMS).alias("drug_name"))


_KW_LIST = "[" + ", ".join(f"'{t}'" for t in text.DRUG_KEYWORDS) + "]"


@register("union_posts", fixtures.oracle_ctes("posts_base") + f"""
, s AS (
  SELECT CASE WHEN tie1 % 43 = 0 THEN NULL ELSE post_id END AS post_id,
         CASE WHEN tie1 % 2 = 0 THEN 'post' ELSE 'comment' END AS kind,
         subreddit, CASE WHEN tie1 % 2 = 0 THEN title ELSE '' END AS title, body, created_utc, tie1
  FROM posts_base)
SELECT post_id, kind, subreddit, body,
  CASE WHEN len(list_filter({_KW_LIST}, lambda k: contains(lower(title || ' ' || body), lower(k)))) = 0 THEN 'unknown'
       ELSE array_to_string(list_filter({_KW_LIST}, lambda k: contains(lower(title || ' ' || body), lower(k))), ',') END
    AS drug_mentions
FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY created_utc, tie1) AS rn
      FROM s WHERE post_id IS NOT NULL AND post_id <> '')
WHERE rn = 1""")
def q_union_posts(spark, sf_dir):
    """S9 + U1: posts and comments mapped to one schema, unioned, first-seen id wins."""
    from pvspark.operators.posts import union_posts
    fp = forum_payload(fixtures.posts_base(spark, sf_dir))
    posts = extract.posts_from_search(fp.filter("is_post").select("data", "seq"), "post")
    comments = extract.posts_from_search(fp.filter("not is_post").select("data", "seq"), "comment")
    u = union_posts(posts, comments, order=["created_utc", "seq"])
    return u.select("post_id", "kind", "subreddit", "body", "drug_mentions")


@register("latest_n", fixtures.oracle_ctes("reports_raw") + """
SELECT report_id, report_date, tie1 FROM reports_raw
ORDER BY report_date DESC NULLS LAST, report_id, ingestion_ts DESC, tie1, tie2, tie3, tie4 LIMIT 1000""")
def q_latest_n(spark, sf_dir):
    """Most recent 1000 reports (a top-k report; the limit is the feature)."""
    from pvspark.operators.posts import latest_n
    r = fixtures.reports_raw(spark, sf_dir)
    return latest_n(r, 1000, ["report_date desc", "report_id", "ingestion_ts desc", "tie1", "tie2", "tie3", "tie4"]) \
        .select("report_id", "report_date", "tie1")


FORUMS = ["click", "view", "error"]
PHRASES = ["red widget", "small"]


@register("safety_term_filter", fixtures.oracle_ctes("posts_raw") + f"""
SELECT tie1 AS event_id, subreddit FROM posts_raw
WHERE subreddit IN ({", ".join(f"'{f}'" for f in FORUMS)})
  AND len(list_filter([{", ".join(f"'{p}'" for p in PHRASES)}],
          lambda k: contains(lower(coalesce(title, '') || ' ' || coalesce(body, '')), k))) > 0""")
def q_safety_term_filter(spark, sf_dir):
    """Forum x safety-phrase search expressed as one filter at the source."""
    from pvspark.operators.posts import filter_safety_terms
    return filter_safety_terms(fixtures.posts_raw(spark, sf_dir), FORUMS, PHRASES) \
        .select(F.col("tie1").alias("event_id"), "subreddit")



@register("latest_articles", fixtures.oracle_ctes("articles_raw") + """
SELECT article_id, publish_date FROM articles_raw
ORDER BY publish_date DESC NULLS LAST, article_id LIMIT 200""")
def q_latest_articles(spark, sf_dir):
    """The 200 newest articles by publication date (ties by id) - a top-k fetch."""
    from pvspark.operators.posts import latest_n
    a = fixtures.articles_raw(spark, sf_dir)
    return latest_n(a, 200, ["publish_date desc", "article_id"]).select("article_id", "publish_date")
