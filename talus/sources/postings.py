"""Readers of raw pages of several shapes: JSON, HTML cards, JSON-LD; all as Column expressions.

A raw row is (item, page, payload).  Each reader gives the posting columns of POSTING.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talus.functions.text import html_text

POSTING = "source string, source_job_id string, url string, title_raw string, company_raw string, location_raw string, skills_raw array<string>, description_raw string, posted_date_raw string, ingested_at timestamp, extra string"


def bronze(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines by schema; malformed lines are left to ``malformed``."""
    return _lines(spark, path).where("_torn is null").drop("_torn")


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``bronze`` leaves out, as they stand: none is lost uncounted."""
    parsed = F.from_json("value", POSTING + ", _torn string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_torn"})
    return spark.read.text(path).where(F.trim("value") != "").select("value", parsed.alias("p")).where("p._torn is not null").select(F.col("value").alias("line"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(POSTING + ", _torn string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_torn")
    return reader.json(path)


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """Cached responses: path and whole text."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("payload"))


def json_items(df: DataFrame, schema: str, at: str = "items") -> DataFrame:
    """A row for each element of the payload's list ``at`` (schema of one element)."""
    parsed = F.from_json("payload", f"struct<{at}:array<{schema}>>")
    return df.withColumn("item_row", F.explode(parsed[at])).select(*[c for c in df.columns if c != "payload"], "item_row.*")


def cards(df: DataFrame, card: str, fields: dict[str, str]) -> DataFrame:
    """A row for each match of the card's pattern in an HTML page; fields by patterns (group 1)."""
    one = df.withColumn("card", F.explode(F.regexp_extract_all("payload", F.lit(card), F.lit(0))))
    return one.select(*[c for c in df.columns if c != "payload"], *[F.nullif(html_text(F.regexp_extract("card", p, 1)), F.lit("")).alias(k) for k, p in fields.items()])


def posting_ld(payload: Column) -> Column:
    """The page's JSON-LD posting: description, datePosted, skills (split at commas), industry."""
    text = F.regexp_extract(payload, r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1)
    ld = F.from_json(text, "`@type` string, description string, datePosted string, skills string, industry string, employmentType string")
    skills = F.filter(F.transform(F.split(ld["skills"], ","), lambda s: F.trim(s)), lambda s: s != "")
    return F.when(ld["@type"] == "JobPosting", F.struct(html_text(ld["description"]).alias("description"), ld["datePosted"].alias("posted"), skills.alias("skills"), ld["industry"].alias("industry"), ld["employmentType"].alias("employment")))


def rich_text(payload: Column) -> Column:
    """All non-blank ``text`` values of a rich-text document, in order, one a line."""
    hits = F.regexp_extract_all(payload, F.lit(r'"text"\s*:\s*("(?:[^"\\]|\\.)*")'), F.lit(1))
    plain = F.transform(hits, lambda x: F.get_json_object(F.concat(F.lit('{"t":'), x, F.lit("}")), "$.t"))
    return F.concat_ws("\n", F.filter(plain, lambda x: F.trim(x) != ""))


def work_model(location: Column) -> tuple[Column, Column]:
    """(work model, rest) of a location that begins with one."""
    kind = F.regexp_extract(location, r"^(At office|Hybrid|Remote)", 1)
    return F.nullif(kind, F.lit("")), F.trim(F.substring(location, F.length(kind) + 1, F.length(location)))


def total(text: Column) -> Column:
    """A number with thousands separators."""
    return F.replace(F.regexp_extract(text, r"(\d[\d,]*)", 1), F.lit(","), F.lit("")).try_cast("int")


def hex_id(url: Column) -> Column:
    """The hex id before ``.html``, else the whole URL."""
    found = F.regexp_extract(url, r"\.([0-9A-Fa-f]{6,})\.html", 1)
    return F.when(found != "", found).otherwise(url)


def in_domain(pattern: str, *columns: str) -> Column:
    """Whether any column matches; null counts as no."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.col(c).rlike(pattern), F.lit(False))
    return out


def paginate(rows: DataFrame, size: int, cap: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Postings of (item, page, pos) pages: of each id the first wins; an item ends after its first
    short or empty page.  Second: per item, how many new ids it brought."""
    lengths = rows.groupBy("item", "page").agg(F.count("*").alias("n"))
    short = lengths.where(F.col("n") < size).groupBy("item").agg(F.min("page").alias("__last"))
    kept = rows.join(short, "item", "left").where(F.col("__last").isNull() | (F.col("page") <= F.col("__last"))).drop("__last")
    kept = kept.where(F.col("page") <= cap) if cap else kept
    first = kept.withColumn("__rn", F.row_number().over(Window.partitionBy("source_job_id").orderBy("item", "page", "pos"))).where("__rn = 1").drop("__rn")
    return first, first.groupBy("item").agg(F.count("*").alias("new_ids"))


def volume(rows: DataFrame) -> DataFrame:
    """Sum of listings, distinct ids and their overlap in percent."""
    return rows.agg(F.count("*").alias("listed"), F.count_distinct("source_job_id").alias("ids")).withColumn("overlap_pct", F.when(F.col("listed") > 0, F.bround(100 * (1 - F.col("ids") / F.col("listed")), 1)))


def volume_by_item(rows: DataFrame) -> DataFrame:
    """What first pages say: a row for each item (its stated ``total``, the listings on page 1), and one of a null
    item with the sum of totals, the listings and the distinct ids of all first pages."""
    first = rows.where("page = 1")
    each = first.groupBy("item").agg(F.max("total").alias("total"), F.count("source_job_id").alias("listed"), F.count_distinct("source_job_id").alias("ids"))
    ids = first.agg(F.count_distinct("source_job_id").alias("ids"))
    sums = each.agg(F.sum("total").alias("total"), F.sum("listed").alias("listed")).crossJoin(ids)  # one row each
    return each.unionByName(sums.select(F.lit(None).cast("string").alias("item"), "total", "listed", "ids"))
