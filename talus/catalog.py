"""All queries of the engine's own operators, each beside the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talus.functions import dates, rules
from talus.functions import text as T
from talus.operators import aggregates as A
from talus.operators import cascade, cdc, dedup, vectors
from talus.plans import discovery, silver
from talus.sources import boards, postings

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query of (read) under its function's name, with its SQL."""

    def add(f):
        _QUERIES[f.__name__] = lambda s, d: f(lambda t: s.read.parquet(f"{d}/{t}.parquet"))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL


def _baskets(read) -> DataFrame:
    return read("lineitem").select("l_orderkey", "l_partkey").join(read("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")


_BASKETS = "SELECT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey"


# --- aggregates ------------------------------------------------------------------------------


@query(f"""SELECT p_brand, count(DISTINCT l_orderkey) AS n, round(100.0::DOUBLE * count(DISTINCT l_orderkey) / (SELECT count(*) FROM orders), 1) AS pct
FROM ({_BASKETS}) GROUP BY p_brand""")
def share_overall(read):
    whole = read("orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return A.share(_baskets(read), "l_orderkey", ["p_brand"], whole=whole, exact=False)


@query(f"""SELECT o_orderpriority, p_brand, count(DISTINCT l_orderkey) AS n, round(100.0::DOUBLE * count(DISTINCT l_orderkey) / any_value(total), 1) AS pct
FROM ({_BASKETS}) b JOIN orders ON l_orderkey = o_orderkey JOIN (SELECT o_orderpriority, count(*) AS total FROM orders GROUP BY 1) t USING (o_orderpriority)
GROUP BY o_orderpriority, p_brand""")
def share_within_group(read):
    orders = read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return A.share(_baskets(read).join(orders, "l_orderkey"), "l_orderkey", ["o_orderpriority", "p_brand"], ["o_orderpriority"], orders, exact=False)


@query("""SELECT r_name, n_name, c_mktsegment, count(DISTINCT c_custkey) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def cross_grain_location(read):
    places = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return A.cross(read("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")), "c_custkey", ["r_name", "n_name", "c_mktsegment"])


@query(f"""WITH b AS (SELECT DISTINCT l_orderkey, p_brand FROM ({_BASKETS}))
SELECT a.p_brand AS item_a, b.p_brand AS item_b, count(*) AS n FROM b a JOIN b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand GROUP BY 1, 2""")
def pair_cooccurrence(read):
    return A.pairs(_baskets(read), "l_orderkey", "p_brand")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(DISTINCT user_id) AS n FROM events GROUP BY 1, 2")
def snapshot_trend(read):
    return A.trend(read("events").withColumn("day", F.date_format("ts", "yyyy-MM-dd")), "user_id", "day", "event_type")


@query("""SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS n_debt, count(*) FILTER (WHERE c_acctbal >= 5000) AS n_rich
FROM customer GROUP BY 1""")
def filtered_counts(read):
    return A.filtered_counts(read("customer"), ["c_mktsegment"], n_debt=F.col("c_acctbal") < 0, n_rich=F.col("c_acctbal") >= 5000)


@query("""SELECT round(100 * avg((quality = 1)::INT), 1) AS quality_rate, round(100 * avg((toxic = 1)::INT), 1) AS toxic_rate,
round(100.0::DOUBLE * count(DISTINCT doc_id) / (SELECT count(*) FROM documents), 1) AS coverage FROM labels""")
def rate_kpis(read):
    whole = read("documents").agg(F.count("*").alias("whole"))
    said = read("labels").agg(A.rate(F.col("quality") == 1, exact=False).alias("quality_rate"), A.rate(F.col("toxic") == 1, exact=False).alias("toxic_rate"), F.count_distinct("doc_id").alias("n"))
    return said.crossJoin(whole).select("quality_rate", "toxic_rate", A.percent(F.col("n"), F.col("whole"), exact=False).alias("coverage"))  # one row each


@query("""SELECT CASE WHEN value < 0 OR value > 1000 THEN NULL WHEN value <= 10 THEN 'low' WHEN value <= 50 THEN 'mid' WHEN value <= 1000 THEN 'high' END AS bin,
count(*) AS n FROM events GROUP BY 1""")
def bins(read):
    return read("events").groupBy(A.right_closed(F.col("value"), [0.0, 10.0, 50.0, 1000.0], ["low", "mid", "high"]).alias("bin")).agg(F.count("*").alias("n"))


@query("""SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2) WHERE rn = 1""")
def mode_by_group(read):
    return A.mode_by(read("events"), ["user_id"], "event_type")


@query("SELECT lang, " + ", ".join(f"count(*) FILTER (WHERE source = 'src{i}') AS src{i}" for i in range(5)) + " FROM documents GROUP BY lang")
def crosstab(read):
    return A.crosstab(read("documents").select("lang", "source"), "lang", "source", [f"src{i}" for i in range(5)])


@query("""SELECT name, null_rate FROM (SELECT round(100 * avg((text IS NULL OR text = '')::INT), 1) AS text, round(100 * avg((lang IS NULL OR lang = '')::INT), 1) AS lang,
round(100 * avg((n_chars IS NULL OR n_chars = 0)::INT), 1) AS n_chars FROM documents) UNPIVOT (null_rate FOR name IN (text, lang, n_chars))""")
def null_profile(read):
    return A.null_profile(read("documents"), ["text", "lang", "n_chars"])


@query("SELECT l_partkey, sum(l_quantity)::BIGINT AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 20")
def topk(read):
    return A.top(read("lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").cast("long").alias("n")), 20, "n", "l_partkey")


@query("""SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents) WHERE rn <= 5""")
def stratified_sample(read):
    return A.stratified(read("documents").select("lang", "doc_id"), "lang", "doc_id", 5)


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, grouping_id(l_returnflag, l_linestatus) AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_levels(read):
    return A.levels(read("lineitem"), "l_returnflag", "l_linestatus")


@query("""SELECT r_name, string_agg(n_name, '; ' ORDER BY n_name = 'CHINA', n_nationkey) AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def grouped_names(read):
    rows = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return A.catalog_text(rows, "r_name", "n_name", "n_nationkey", "CHINA")


@query("SELECT c_mktsegment, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1")
def share_preview(read):
    return A.share(read("customer").where("c_mktsegment <> 'BUILDING'"), "c_custkey", ["c_mktsegment"], exact=False)


@query("""SELECT count(*) FILTER (WHERE n >= 2) AS multi, count(*) AS n FROM (SELECT l_orderkey, count(DISTINCT p_brand) FILTER (WHERE p_brand IN
('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21', 'Brand#22', 'Brand#23')) AS n FROM (""" + _BASKETS + ") GROUP BY 1)")
def core_threshold(read):
    return A.core_counts(_baskets(read), "l_orderkey", "p_brand", [f"Brand#{i}{j}" for i in (1, 2) for j in (1, 2, 3)])


@query("""SELECT facet, value, count(*) AS n FROM (SELECT unnest(['lang', 'source']) AS facet, unnest([lang, source]) AS value FROM documents) GROUP BY 1, 2
UNION ALL SELECT 'rows', '', count(*) FROM documents UNION ALL SELECT 'active', '', count(*) FILTER (WHERE lang <> 'en') FROM documents""")
def corpus_overview(read):
    return A.overview(read("documents").select("lang", "source", (F.col("lang") != "en").alias("active")), "active", "lang", "source")


@query(r"""SELECT count(*) AS n, count(*) FILTER (WHERE regexp_matches(text, 'MIT|BSD')) AS plain, count(*) FILTER (WHERE regexp_matches(text, 'GNU|Creative|CC')) AS share_alike,
count(*) FILTER (WHERE NOT regexp_matches(text, 'MIT|BSD') AND NOT regexp_matches(text, 'GNU|Creative|CC')) AS neither FROM documents WHERE regexp_matches(text, '(?i)licen[sc]e')""")
def branch_evidence(read):
    return A.evidence(read("documents"), "text", "(?i)licen[sc]e", plain="MIT|BSD", share_alike="GNU|Creative|CC")


@query("""WITH m AS (SELECT c_nationkey, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS rn FROM customer GROUP BY 1, 2)
SELECT c_nationkey, count(*) AS n, round(avg(c_custkey), 3) AS mean_c_custkey, any_value(m.c_mktsegment) AS top_c_mktsegment FROM customer JOIN m USING (c_nationkey) WHERE rn = 1 GROUP BY 1""")
def group_profile(read):
    return A.profile(read("customer"), "c_nationkey", ["c_mktsegment"], "c_custkey")


@query("""SELECT c_nationkey, string_agg(c_mktsegment || ' (' || n || ')', ', ' ORDER BY n DESC, c_mktsegment) AS top FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n,
row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS rn FROM customer GROUP BY 1, 2) WHERE rn <= 3 GROUP BY 1""")
def top_items(read):
    return discovery.top_items(read("customer"), ["c_nationkey"], F.array("c_mktsegment"), 3)


@query("""SELECT branch, count(*) AS n, count(*) FILTER (WHERE source = 'src0') AS n_other FROM (SELECT source, unnest([CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'license' END, CASE WHEN regexp_matches(text, 'token') THEN 'token' END]) AS branch FROM documents)
WHERE branch IS NOT NULL GROUP BY 1""")
def branch_candidates(read):
    texts = read("documents").select(
        F.col("doc_id").alias("job_id"), F.col("text").alias("title"), F.array("lang").alias("skills"), "source", "lang", F.when(F.col("source") == "src0", "OTHER").otherwise("DATA").alias("role_category"), F.lit(True).alias("is_active")
    )
    clusters = texts.select("job_id", F.lit("all").alias("scope"), F.lit(0).alias("cluster_id"), F.lit(0.0).alias("silhouette_sample"))
    return discovery.discovery(texts, clusters, ["OTHER", "DATA"], {"license": "(?i)licen[sc]e", "token": "token"})["branches"]


@query("""SELECT l_partkey, l_orderkey FROM (SELECT l_partkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_orderkey) AS rn FROM lineitem WHERE l_linenumber <= 3)
WHERE rn = 1 ORDER BY l_linenumber, l_orderkey LIMIT 25""")
def bounded_sample(read):
    return A.first_pages(read("lineitem"), "l_partkey", 25, "l_linenumber", ("l_linenumber", "l_orderkey")).select("l_partkey", "l_orderkey")


@query(r"""SELECT term, count(*) AS n FROM (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM (
    SELECT list_filter(regexp_extract_all(lower(regexp_extract(html, '<title>(.*?)</title>', 1)), '([a-z]+)', 1), lambda x: length(x) > 1 AND x NOT IN ('the', 'of')) AS w FROM pages)) GROUP BY 1""")
def ngrams(read):
    words = T.tokens(F.regexp_extract("html", "<title>(.*?)</title>", 1), ["the", "of"], "[a-z]+")
    return read("pages").select(F.explode(A.terms(words)).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


@query("""SELECT round(100 * avg(CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN a = b THEN 1 ELSE 0 END), 1) AS agreement, count(*) AS n
FROM (SELECT quality AS a, CASE WHEN toxic = 0 THEN 1 ELSE 0 END AS b FROM labels)""")
def agreement(read):
    votes = F.array(F.col("quality"), F.when(F.col("toxic") == 0, 1).otherwise(0))
    return read("labels").agg(F.round(100 * F.avg(A.agreement(votes)), 1).alias("agreement"), F.count("*").alias("n"))


# --- change tracking -------------------------------------------------------------------------


def _versions(read) -> tuple[DataFrame, DataFrame]:
    """Customers of finished orders as the old version, those of open orders as the new one."""
    of = lambda status, v: read("orders").where(F.col("o_orderstatus") == status).select("o_custkey").distinct().withColumn("v", F.lit(v))
    return of("F", "old"), of("O", "new")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def first_wins(read):
    return cdc.first_wins(read("events"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")


@query("""SELECT n.doc_id, CASE WHEN n.lang = '' THEN coalesce(o.lang, n.lang) ELSE n.lang END AS lang FROM
(SELECT doc_id, CASE WHEN source = 'src0' THEN '' ELSE lang END AS lang FROM documents) n
LEFT JOIN (SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) o USING (doc_id)""")
def carry_forward(read):
    docs = read("documents").select("doc_id", "lang", "source")
    now = docs.select("doc_id", F.when(F.col("source") == "src0", "").otherwise(F.col("lang")).alias("lang"))
    return cdc.carry_forward(now, docs.join(read("labels"), "doc_id", "left_semi"), "doc_id", ["lang"])


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN nullif(l.quality, 0) ELSE -1 END AS quality FROM documents d LEFT JOIN labels l USING (doc_id)""")
def update_from(read):
    target = read("documents").select("doc_id", F.lit(-1).alias("quality"))
    return cdc.update_from(target, read("labels").select("doc_id", F.nullif("quality", F.lit(0)).alias("quality")), "doc_id", ["quality"])


@query("""SELECT coalesce(b.o_custkey, a.o_custkey) AS o_custkey, coalesce(b.v, a.v) AS v FROM (SELECT DISTINCT o_custkey, 'old' AS v FROM orders WHERE o_orderstatus = 'F') a
FULL JOIN (SELECT DISTINCT o_custkey, 'new' AS v FROM orders WHERE o_orderstatus = 'O') b ON a.o_custkey = b.o_custkey""")
def upsert_merge(read):
    old, new = _versions(read)
    return cdc.upsert(old, new, "o_custkey")


@query("""SELECT o_custkey, max(CASE o_orderstatus WHEN 'F' THEN 'old' ELSE 'new' END) AS v FROM orders
WHERE o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) GROUP BY 1""")
def anti_insert(read):
    old, new = _versions(read)
    return cdc.insert_missing(old, new, "o_custkey")


@query("""WITH log AS (SELECT DISTINCT event_type, user_id, ts::DATE AS day FROM events),
runs AS (SELECT event_type, day, row_number() OVER (PARTITION BY event_type ORDER BY day) AS no FROM (SELECT DISTINCT event_type, day FROM log)),
k AS (SELECT event_type, user_id, min(day) AS first_seen, max(day) AS last_seen FROM log GROUP BY 1, 2),
m AS (SELECT k.*, r.no, (SELECT max(no) FROM runs x WHERE x.event_type = k.event_type) - r.no AS missed, CASE WHEN k.event_type = 'click' THEN 1 ELSE 2 END AS need
      FROM k JOIN runs r ON r.event_type = k.event_type AND r.day = k.last_seen)
SELECT m.event_type, user_id, strftime(first_seen, '%Y-%m-%d') AS first_seen, strftime(last_seen, '%Y-%m-%d') AS last_seen, missed < need AS is_active,
strftime(e.day, '%Y-%m-%d') AS removed, CASE WHEN need = 1 THEN 0 ELSE least(missed, 2) END::BIGINT AS miss_streak
FROM m LEFT JOIN runs e ON e.event_type = m.event_type AND missed >= need AND e.no = m.no + need""")
def cdc_state(read):
    log = read("events").select("event_type", "user_id", F.to_date("ts").alias("snapshot_date")).distinct()
    out = cdc.replay(log, ["event_type", "user_id"], "event_type", F.col("event_type") == "click")
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_seen", "last_seen", "removed")})


@query("""SELECT event_type, count(*) FILTER (WHERE day = last_day) AS n_now, count(*) FILTER (WHERE day = first_day) AS n_first FROM
(SELECT event_type, ts::DATE AS day, max(ts::DATE) OVER () AS last_day, min(ts::DATE) OVER () AS first_day FROM events) GROUP BY 1""")
def run_counts(read):
    days = read("events").select("event_type", F.to_date("ts").alias("day"))
    ends = days.agg(F.max("day").alias("last_day"), F.min("day").alias("first_day"))
    return days.crossJoin(F.broadcast(ends)).groupBy("event_type").agg(F.count_if(F.col("day") == F.col("last_day")).alias("n_now"), F.count_if(F.col("day") == F.col("first_day")).alias("n_first"))  # one row


@query("""SELECT content_hash, count(*) AS n, min(doc_id) AS first_id FROM (SELECT doc_id, sha256(coalesce(text, '') || chr(0) || coalesce(lang, '') || chr(0))[1:16] AS content_hash
FROM documents) GROUP BY 1""")
def hash_dedup(read):
    rows = read("documents").select("doc_id", T.content_hash(F.col("text"), F.col("lang")).alias("content_hash"))
    return rows.groupBy("content_hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query("""SELECT d.doc_id, f.first_id FROM (SELECT doc_id, sha256(coalesce(text, '') || chr(0)) AS h FROM documents) d
JOIN (SELECT sha256(coalesce(text, '') || chr(0)) AS h, min(doc_id) AS first_id FROM documents GROUP BY 1) f USING (h)""")
def hash_fan_out(read):
    rows = read("documents").select("doc_id", T.content_hash(F.col("text")).alias("h"))
    once = dedup.representatives(rows, "h", "doc_id").select("h", F.col("doc_id").alias("first_id"))
    return dedup.fan_out(rows, once, "h", ["first_id"]).select("doc_id", "first_id")


@query("""SELECT d.doc_id, CASE WHEN d.source = 'src0' AND l.quality = 1 THEN 'good' WHEN d.source = 'src0' THEN '' ELSE d.lang END AS lang,
CASE WHEN l.doc_id IS NOT NULL THEN l.toxic::VARCHAR ELSE 'old' END AS toxic, 'kept' AS other FROM documents d LEFT JOIN labels l USING (doc_id)""")
def fill_details(read):
    now = read("documents").select("doc_id", F.when(F.col("source") == "src0", "").otherwise(F.col("lang")).alias("lang"), F.create_map(F.lit("toxic"), F.lit("old"), F.lit("other"), F.lit("kept")).alias("extra"))
    details = read("labels").select("doc_id", F.when(F.col("quality") == 1, "good").alias("lang"), "toxic")
    out = cdc.fill_details(now, details, "doc_id", ["lang"], "extra", ["toxic"])
    return out.select("doc_id", "lang", F.col("extra")["toxic"].alias("toxic"), F.col("extra")["other"].alias("other"))


# --- text ------------------------------------------------------------------------------------

_ROLES = [("A", ["almond", "antique azure"]), ("B", ["blue", "burnished"]), ("C", ["chocolate", "red", "green"])]
_ALIASES = [("NAVY", "navy blue"), ("BLUE", "blue"), ("THE_AND", "the and"), ("OF_THE", "of the"), ("OF", "of the and"), ("FR", "les des")]


def _word(c: str, words: list[str]) -> str:
    return f"regexp_matches({c}, '(^|[^\\pL\\pN_])({'|'.join(words)})($|[^\\pL\\pN_])')"


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN {_word('lower(p_name)', p)} THEN '{r}'" for r, p in _ROLES) + " ELSE 'OTHER' END AS role FROM part")
def first_rule_wins(read):
    return read("part").select("p_partkey", T.first_rule(T.norm(F.col("p_name")), _ROLES, "OTHER").alias("role"))


@query(r"""WITH d AS (SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[_\-/]+', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE """ + " ".join(f"WHEN {_word('t', [a])} THEN '{c}'" for c, a in sorted((x for x in _ALIASES if " " in x[1]), key=lambda x: -len(x[1]))) + " END AS code FROM d")
def longest_alias(read):
    return read("documents").select("doc_id", T.longest_alias(T.rule_norm(F.col("text")), _ALIASES)["code"].alias("code"))


_TERMS = {"license": "License", "licence": "License", "version": "Version", "token": "Token", "password": "Secret", "des": "DES", "und": "UND"}


@query("""WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents) SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([""" + ", ".join(f"CASE WHEN regexp_matches(t, '(^|[^a-z0-9]){a}($|[^a-z0-9])') THEN '{c}' END" for a, c in _TERMS.items()) + """], lambda x: x IS NOT NULL))), ',') AS terms FROM d""")
def dictionary_extract(read):
    found, _ = T.extract_terms(F.array().cast("array<string>"), F.col("text"), _TERMS)
    return read("documents").select("doc_id", F.array_join(found, ",").alias("terms"))


@query("""SELECT doc_id, CASE WHEN a > 0 AND (b = 0 OR a <= b) AND (c = 0 OR a <= c) THEN 'und' WHEN b > 0 AND (c = 0 OR b <= c) THEN 'les' WHEN c > 0 THEN 'que' END AS place
FROM (SELECT doc_id, strpos(lower(text), 'und') AS a, strpos(lower(text), 'les') AS b, strpos(lower(text), 'que') AS c FROM documents)""")
def first_position(read):
    places = [("und", "x", ["und"]), ("les", "y", ["les"]), ("que", "z", ["que"])]
    return read("documents").select("doc_id", T.first_place(F.lower("text"), places)["place"].alias("place"))


@query("SELECT doc_id, md5(strip_accents(text)) AS plain FROM documents")
def strip_accents(read):
    return read("documents").select("doc_id", F.md5(T.strip_accents(F.col("text"))).alias("plain"))


@query(r"""SELECT c_custkey, nullif(trim(regexp_replace(regexp_replace(lower(c_name), '\b(customer|inc)\b', ' ', 'g'), '\s+', ' ', 'g'), ' .,-'), '') AS company FROM customer""")
def clean_key(read):
    return read("customer").select("c_custkey", T.clean_company(F.col("c_name"), ["customer", "inc"]).alias("company"))


@query(r"""SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_replace(t, '[\(\[\{].*?[\)\]\}]', ' ', 'g'), '\s+', ' ', 'g')), ''), trim(t)) AS title
FROM (SELECT page_id, '(new) ' || url || ' [x]' AS t FROM pages)""")
def clean_title(read):
    return read("pages").select("page_id", T.clean_title(F.concat(F.lit("(new) "), "url", F.lit(" [x]"))).alias("title"))


@query(r"""SELECT doc_id, coalesce(round(length(regexp_replace(lower(text), '[^éèêçàñóíáúäöüß]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(lower(text), '\PL', '', 'g')), 0), 4), 0) AS ratio FROM documents""")
def letter_ratio(read):
    return read("documents").select("doc_id", T.letter_ratio(F.col("text"), "éèêçàñóíáúäöüß").alias("ratio"))


@query(r"""SELECT doc_id, md5(trim(regexp_replace(lang || ' Skills: ' || source || ', x ' || left(trim(regexp_replace(array_to_string(list_filter(string_split(text, chr(10)),
lambda x: NOT regexp_matches(lower(x), 'licen[sc]e|token')), ' '), '\s+', ' ', 'g')), 4000), '\s+', ' ', 'g'))) AS kept FROM documents""")
def line_filter(read):
    return read("documents").select("doc_id", F.md5(T.view(F.col("lang"), F.array("source", F.lit("x")), F.col("text"), "licen[sc]e|token")).alias("kept"))


@query("""SELECT o_orderkey, strftime(CASE o_orderkey % 4 WHEN 3 THEN DATE '2026-06-16' - (o_orderkey % 5)::INT WHEN 2 THEN DATE '2026-06-16' ELSE o_orderdate::DATE END, '%Y-%m-%d') AS posted FROM orders""")
def date_parse(read):
    raw = (
        F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+07:00'"))
        .when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "dd-MM-yyyy"))
        .when(F.col("o_orderkey") % 4 == 2, F.lit("3 hours ago"))
        .otherwise(F.concat((F.col("o_orderkey") % 5).cast("string"), F.lit(" days ago")))
    )
    return read("orders").select("o_orderkey", F.date_format(dates.posted_date(raw, F.lit("2026-06-16").cast("date")), "yyyy-MM-dd").alias("posted"))


_SOURCES = ["itviec", "topdev", "careerviet", "glints", "else"]
_RAW = ["3 days ago", "05-03-2026", "Hạn nộp: 30-09-2026 Cập nhật: 09-06-2026", "2026-06-05T07:32:34.028Z", "2026-06-05Tgarbage"]


@query("""SELECT c_custkey, CASE WHEN s = 0 AND r = 0 THEN '2026-06-13' WHEN s = 1 AND r = 1 THEN '2026-03-05' WHEN s = 2 AND r = 2 THEN '2026-06-09' WHEN s >= 3 AND r = 3 THEN '2026-06-05' END AS posted
FROM (SELECT c_custkey, c_custkey % 5 AS s, c_custkey // 5 % 5 AS r FROM customer)""")
def date_by_source(read):
    pick = lambda values, at: F.get(F.array(*map(F.lit, values)), at.cast("int"))
    source, raw = pick(_SOURCES, F.col("c_custkey") % 5), pick(_RAW, F.floor(F.col("c_custkey") / 5) % 5)
    return read("customer").select("c_custkey", F.date_format(dates.posted_date(raw, F.lit("2026-06-16").cast("date"), source), "yyyy-MM-dd").alias("posted"))


@query(r"""SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>', ' ', 'g'),
'&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))) AS body FROM pages""")
def html_text(read):
    return read("pages").select("page_id", F.md5(T.html_text(F.col("html"))).alias("body"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(read):
    rows = read("events").select("event_id", F.concat(F.lit('{"items": ['), "props", F.lit("]}")).alias("payload"))
    return postings.json_items(rows, "struct<k:string>").select("event_id", "k")


@query("""SELECT o_orderkey, CASE WHEN regexp_matches(o_orderpriority, '(?i)urgent|high') THEN true ELSE false END AS hot FROM orders""")
def regex_filter(read):
    return read("orders").select("o_orderkey", postings.in_domain("(?i)urgent|high", "o_orderpriority").alias("hot"))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(lower(text), 'der ') THEN 'DE' END, CASE WHEN contains(lower(text), 'les ') OR contains(lower(text), 'des ') THEN 'FR' END], lambda x: x IS NOT NULL), ',') AS codes FROM documents""")
def substring_codes(read):
    return read("documents").select("doc_id", F.array_join(T.codes_of(F.lower("text"), [("DE", ["der "]), ("FR", ["les ", "des "])]), ",").alias("codes"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'Remote' WHEN n_nationkey % 3 = 1 THEN 'Hybrid' END AS kind, n_name || ' Remote' AS rest FROM nation""")
def prefix_split(read):
    model = F.when(F.col("n_nationkey") % 3 == 0, "Remote ").when(F.col("n_nationkey") % 3 == 1, "Hybrid").otherwise("")
    kind, rest = postings.work_model(F.concat(model, "n_name", F.lit(" Remote")))
    return read("nation").select("n_nationkey", kind.alias("kind"), rest.alias("rest"))


# --- vectors, cascade, dedup -----------------------------------------------------------------


@query("""WITH p AS (SELECT label, list(v ORDER BY i) AS p FROM (SELECT label, i, avg(v::DOUBLE) AS v FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT vec_id, p.label, list_inner_product(embedding::DOUBLE[], p) AS s, row_number() OVER (PARTITION BY vec_id ORDER BY list_inner_product(embedding::DOUBLE[], p) DESC, p.label) AS rn FROM embeddings, p)
SELECT a.vec_id, a.label AS best, round(a.s, 4) AS similarity, round(a.s - b.s, 4) AS margin FROM s a JOIN s b ON a.vec_id = b.vec_id AND a.rn = 1 AND b.rn = 2""")
def prototype_match(read):
    vecs = read("embeddings")
    out = vectors.match(vecs, vectors.prototypes(vecs, "label", "embedding"), "label", "embedding", 0.82, 0.02)
    return out.select("vec_id", "best", F.round("similarity", 4).alias("similarity"), F.round("margin", 4).alias("margin"))


@query("""SELECT method, count(*) AS n FROM (SELECT CASE WHEN code = 1 THEN 'rule' WHEN length(text) > 1000 THEN 'embedding' ELSE 'open' END AS method FROM
(SELECT text, CASE WHEN """ + _word("lower(text)", ["license"]) + """ THEN 1 ELSE 0 END AS code FROM documents)) GROUP BY 1""")
def cascade_mix(read):
    rule = T.longest_alias(F.lower("text"), [("LIC", "license")], {"license"})["code"]
    score = F.when(F.length("text") > 1000, 0.9).otherwise(0.5)
    out = cascade.tiers(read("documents"), rule, F.lit("VEC"), score, F.lit(0.1))
    return out.groupBy(F.coalesce("method", F.lit("open")).alias("method")).agg(F.count("*").alias("n"))


_LABELS = """SELECT doc_id::VARCHAR AS job_id, code AS job_family, CASE code WHEN 'LICENSED' THEN 0.9 WHEN 'SHORT' THEN 0.9 WHEN 'LONG' THEN 0.7 WHEN 'MID' THEN 0.5 ELSE 0.0 END::DOUBLE AS confidence_score,
CASE code WHEN 'LICENSED' THEN 'rule' WHEN 'SHORT' THEN 'embedding' WHEN 'OTHER' THEN 'failed' ELSE 'llm:stub' END AS labeling_method,
CASE code WHEN 'LICENSED' THEN 'title alias ''license''' WHEN 'SHORT' THEN 'embed sim 0.90 (margin 0.10)' WHEN 'LONG' THEN 'long' WHEN 'MID' THEN 'middling' ELSE 'stub failed' END AS reasoning,
CASE WHEN code IN ('MID', 'OTHER') THEN 'manual_review' ELSE 'resolved' END AS review_status, CASE code WHEN 'LONG' THEN 'E' WHEN 'MID' THEN 'E' WHEN 'OTHER' THEN 'OTHER' ELSE 'D' END AS domain FROM
(SELECT doc_id, CASE WHEN """ + _word("lower(coalesce(text, ''))", ["license"]) + """ THEN 'LICENSED' WHEN length(text) < 300 THEN 'SHORT' WHEN length(text) > 1000 THEN 'LONG' WHEN length(text) > 500 THEN 'MID' ELSE 'OTHER' END AS code FROM documents)"""


def _labels(read):
    docs = read("documents").select(F.col("doc_id").cast("string").alias("job_id"), "text", T.content_hash(F.col("text")).alias("content_hash"))
    found = T.longest_alias(F.lower("text"), [("LICENSED", "license")], {"license"})
    rows = cascade.tiers(docs, found["code"], F.lit("SHORT"), F.when(F.length("text") < 300, 0.9).otherwise(0.1), F.lit(0.1), found["alias"])
    names = docs.sparkSession.createDataFrame([("LICENSED", "D", "S1"), ("SHORT", "D", "S2"), ("LONG", "E", "S3"), ("MID", "E", "S4"), ("OTHER", "OTHER", "OTHER")], "code string, domain string, subdomain string")
    judge = lambda t: ("LONG", 0.7, "long") if len(t) > 1000 else ("MID", 0.5, "middling") if len(t) > 500 else (None, 0.1, "unclear")
    return cascade.label(rows, "content_hash", "text", "job_id", judge, "stub", names)


@query(_LABELS)
def cascade_labels(read):
    return _labels(read).select("job_id", "job_family", "confidence_score", "labeling_method", "reasoning", "review_status", "domain")


@query(f"""SELECT count(*) AS n, 100.0::DOUBLE AS coverage, round_even(100 * avg((review_status = 'manual_review')::INT), 1) AS manual_rate, round_even(100 * avg((job_family = 'OTHER')::INT), 1) AS other_rate,
NULL::DOUBLE AS agreement, count(*) FILTER (WHERE starts_with(labeling_method, 'llm')) AS n_judged FROM ({_LABELS})""")
def labeling_kpis(read):
    return cascade.kpis(_labels(read))


@query(f"""SELECT facet, value, count(*) AS n FROM (SELECT unnest(['labeling_method', 'job_family', 'domain', 'confidence']) AS facet, unnest([labeling_method, job_family, CASE WHEN job_family <> 'OTHER' THEN domain END,
CASE WHEN confidence_score <= 0.5 THEN '<0.5' WHEN confidence_score <= 0.66 THEN '0.5-0.66' WHEN confidence_score <= 0.85 THEN '0.66-0.85' ELSE '0.85-1.0' END]) AS value FROM ({_LABELS})) WHERE value IS NOT NULL GROUP BY 1, 2""")
def label_distributions(read):
    return cascade.distributions(_labels(read))


@query(f"""WITH l AS ({_LABELS}), f AS (SELECT greatest(1, 40 // count(DISTINCT job_family)) AS per FROM l)
SELECT job_id, d.lang AS title, job_family, confidence_score, labeling_method, review_status, '' AS human_family FROM (SELECT *, row_number() OVER (PARTITION BY job_family ORDER BY md5('42:' || job_id), job_id) AS rn FROM l) s
LEFT JOIN (SELECT doc_id::VARCHAR AS job_id, lang FROM documents WHERE source <> 'src0') d USING (job_id) WHERE rn <= (SELECT per FROM f)""")
def spot_check(read):
    titles = read("documents").where("source <> 'src0'").select(F.col("doc_id").cast("string").alias("job_id"), F.col("lang").alias("title"))
    return cascade.spot_check(_labels(read), titles, "job_id", "title")


@query("""SELECT content, code, judge FROM (SELECT conv_id AS content, 'C' || (turn % 3) AS code, role AS judge, row_number() OVER (PARTITION BY conv_id
ORDER BY CASE role WHEN 'assistant' THEN 1 WHEN 'user' THEN 2 ELSE 3 END, role, (turn % 10) / 10.0, 'C' || (turn % 3)) AS rn FROM conversations WHERE turn % 4 <> 0) WHERE rn = 1""")
def cache_probe(read):
    torn = F.when(F.col("turn") % 4 != 0, F.concat(F.lit("C"), (F.col("turn") % 3).cast("string")))
    cache = read("conversations").select(F.col("conv_id").alias("content"), torn.alias("code"), ((F.col("turn") % 10) / 10.0).alias("confidence"), F.col("role").alias("judge"))
    return cascade.first_answers(cache, "content", ["assistant", "user"]).select("content", "code", "judge")


@query()
def fuzzy_dedup(read):
    return dedup.fuzzy(read("part"), "p_partkey", "p_brand", "p_type", "p_name", ["p_partkey"]).select("p_partkey", "is_duplicate_of")


@query()
def kmeans_assign(read):
    vecs = read("embeddings").select("vec_id", "embedding", "label")
    scopes = {"all": (F.lit(True), vectors.K_ALL), "other": (F.col("label") >= 5, vectors.K_PART)}
    return vectors.cluster_scopes(vecs, "vec_id", "embedding", scopes, run_id="kmeans")


@query("""WITH c AS (SELECT label, count(*) AS n, sum(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norms FROM embeddings GROUP BY 1),
v AS (SELECT label, list(v ORDER BY i) AS sums FROM (SELECT label, i, sum(v::DOUBLE) AS v FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1),
d AS (SELECT vec_id, e.label AS own, c.label, (list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) * n + norms - 2 * list_inner_product(embedding::DOUBLE[], sums)) / CASE WHEN e.label = c.label THEN greatest(n - 1, 1) ELSE n END AS d
      FROM embeddings e, c JOIN v USING (label))
SELECT vec_id, round(round((b - a) / greatest(a, b), 4)::DECIMAL(18, 9), 3)::DOUBLE AS silhouette FROM (SELECT vec_id, max(d) FILTER (WHERE own = label) AS a, min(d) FILTER (WHERE own <> label) AS b FROM d GROUP BY 1)""")
def silhouettes(read):
    rows = vectors.silhouette_samples(read("embeddings"), "embedding", "label")
    return rows.select("vec_id", F.round(F.col("silhouette_sample").cast("decimal(18,9)"), 3).cast("double").alias("silhouette"))


@query()
def hashed_embedding(read):
    return vectors.embed(read("documents"), "doc_id", "text", vectors.hashing_encoder())


_PLACES = ["Quận 1, Hồ Chí Minh; Hà Nội", "Hải Phòng / TPHCM", "Đà Nẵng", "BINH DUONG", "Thừa  Thiên - Huế", ""]


@query("""SELECT n_nationkey, CASE n_nationkey % 6 WHEN 0 THEN 'Hồ Chí Minh' WHEN 1 THEN 'Hải Phòng' WHEN 3 THEN 'Bình Dương' WHEN 4 THEN 'Huế' END AS place,
CASE n_nationkey % 6 WHEN 0 THEN 'South' WHEN 1 THEN 'North' WHEN 3 THEN 'South' WHEN 4 THEN 'Central' END AS region FROM nation""")
def normalised_places(read):
    raw = F.concat(F.get(F.array(*map(F.lit, _PLACES)), F.col("n_nationkey") % 6), F.lit(" "), F.lower("n_name"))
    rows = read("nation").select("n_nationkey", T.first_place(T.strip_accents(T.norm(raw)), rules.CITIES).alias("p"))
    return rows.select("n_nationkey", "p.place", "p.region")


def _postings(read) -> DataFrame:
    """Raw postings made of customers: what each column says follows from the key."""
    k = F.col("c_custkey")
    pick = lambda *values: F.get(F.array(*[F.lit(v).cast("string") for v in values]), (k % len(values)).cast("int"))
    extra = F.to_json(F.struct(pick(None, "Senior", None).alias("seniority_label"), pick("analyst", "boss").alias("position_label"), pick("Tiếng Nhật", None, "x").alias("language_req_raw"), pick("Remote", "At office").alias("work_model")))
    return read("customer").select(
        F.lit("s").alias("source"), k.cast("string").alias("source_job_id"), pick("Worker", "WORKÈR (new)", "Intern").alias("title_raw"), F.concat(F.lit("Firm "), F.floor(k / 6).cast("string"), F.lit(" JSC")).alias("company_raw"),
        F.lit("Hà Nội").alias("location_raw"), F.array(pick("sql", "cobol", "PY", "x")).alias("skills_raw"), pick("Ngân Hàng", "plain", "needs English").alias("description_raw"), extra.alias("extra"), F.lit("2026-01-01").alias("effective_date"), F.lit(True).alias("is_active"),
    )


def _silver(read) -> DataFrame:
    return silver.normalise(_postings(read), {"sql": "SQL", "py": "Python"}, [("DB", ["sql"]), ("DEV", ["Python"]), ("BOSS", ["Boss"])], [("bank", ["ngân hàng"])])


_SILVER = """SELECT 's:' || k AS job_id, CASE WHEN k % 4 = 0 THEN 'DB' WHEN k % 4 = 2 THEN 'DEV' WHEN k % 2 = 1 THEN 'BOSS' ELSE 'OTHER' END AS role_category,
CASE WHEN k % 3 = 2 THEN 'Intern' WHEN k % 3 = 1 THEN 'Senior' ELSE 'Mid' END AS seniority, CASE k % 3 WHEN 0 THEN 'JP' WHEN 2 THEN 'EN' ELSE '' END AS languages, k % 2 = 0 AS remote,
CASE k % 3 WHEN 0 THEN 'bank' ELSE 'other' END AS company_type, CASE k % 4 WHEN 1 THEN 'cobol' WHEN 3 THEN 'x' ELSE '' END AS unmapped,
(SELECT 's:' || min(c2.c_custkey::VARCHAR) FROM customer c2 WHERE c2.c_custkey // 6 = k // 6 AND ((c2.c_custkey % 3 = 2) = (k % 3 = 2))) AS first FROM (SELECT c_custkey AS k FROM customer)"""


@query(f"SELECT * EXCLUDE (first), CASE WHEN first <> job_id THEN first END AS is_duplicate_of FROM ({_SILVER})")
def silver_rows(read):
    return _silver(read).select("job_id", "role_category", "seniority", F.array_join("language_req", ",").alias("languages"), F.col("remote_flag").alias("remote"), "company_type", F.array_join("unmapped", ",").alias("unmapped"), "is_duplicate_of")


@query(f"SELECT company_type, role_category AS job_family, count(*) AS n FROM ({_SILVER}) WHERE first = job_id AND role_category <> 'OTHER' GROUP BY 1, 2")
def gold_company(read):
    rows = _silver(read).withColumns({"job_family": F.col("role_category"), "domain": F.lit("d")})
    return silver.family_gold(rows)["gold_company"]


# --- sources ---------------------------------------------------------------------------------


@query("""WITH r AS (SELECT l_orderkey, l_partkey, l_linenumber, (l_linenumber - 1) // 3 AS page FROM lineitem),
ends AS (SELECT l_orderkey, min(page) AS last_page FROM (SELECT l_orderkey, page FROM r GROUP BY 1, 2 HAVING count(*) < 3) GROUP BY 1),
f AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS rn FROM r LEFT JOIN ends USING (l_orderkey) WHERE last_page IS NULL OR page <= last_page)
SELECT l_orderkey AS item, count(*) AS new_ids FROM f WHERE rn = 1 GROUP BY 1""")
def paginated(read):
    page = F.floor((F.col("l_linenumber") - 1) / 3)
    rows = read("lineitem").select(F.col("l_orderkey").alias("item"), page.alias("page"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("source_job_id"))
    return postings.paginate(rows, 3)[1]


@query("SELECT count(*) AS listed, count(DISTINCT l_partkey) AS ids, round_even(100 * (1 - count(DISTINCT l_partkey)::DOUBLE / count(*)), 1) AS overlap_pct FROM lineitem")
def volume_estimate(read):
    return postings.volume(read("lineitem").select(F.col("l_partkey").alias("source_job_id")))


@query("""WITH p AS (SELECT 'q' || l_linenumber AS item, l_partkey, l_orderkey % 3 + 1 AS page, l_linenumber * 100 AS total FROM lineitem)
SELECT item, max(total)::BIGINT AS total, count(*) AS listed, count(DISTINCT l_partkey) AS ids FROM p WHERE page = 1 GROUP BY 1
UNION ALL SELECT NULL, (SELECT sum(DISTINCT total)::BIGINT FROM p WHERE page = 1), count(*), count(DISTINCT l_partkey) FROM p WHERE page = 1""")
def volume_by_item(read):
    rows = read("lineitem").select(F.concat(F.lit("q"), "l_linenumber").alias("item"), F.col("l_partkey").alias("source_job_id"), (F.col("l_orderkey") % 3 + 1).alias("page"), (F.col("l_linenumber") * 100).cast("long").alias("total"))
    return postings.volume_by_item(rows)


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Hybrid' WHEN 'MACHINERY' THEN 'Remote' WHEN 'FURNITURE' THEN 'At office' END AS model, trim(c_name) AS rest FROM customer""")
def work_models(read):
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "Hybrid").when(F.col("c_mktsegment") == "MACHINERY", "Remote").when(F.col("c_mktsegment") == "FURNITURE", "At office").otherwise("")
    model, rest = postings.work_model(F.concat(kind, F.lit(" "), "c_name"))
    return read("customer").select("c_custkey", model.alias("model"), rest.alias("rest"))


@query("SELECT o_orderkey, o_orderkey::INT AS total FROM orders")
def thousands(read):
    return read("orders").select("o_orderkey", postings.total(F.concat(F.lit("about "), F.format_number("o_orderkey", 0), F.lit(" rows"))).alias("total"))


@query("SELECT c_custkey, CASE WHEN length(h) >= 6 THEN h ELSE 'https://x.example/a.' || h || '.html' END AS id FROM (SELECT c_custkey, lower(hex(c_custkey * 2000)) AS h FROM customer)")
def hex_ids(read):
    url = F.concat(F.lit("https://x.example/a."), F.lower(F.hex(F.col("c_custkey") * 2000)), F.lit(".html"))
    return read("customer").select("c_custkey", postings.hex_id(url).alias("id"))


@query("""SELECT lang, count(*) AS n FROM documents WHERE coalesce(regexp_matches(text, '(?i)licen[sc]e'), false) OR coalesce(regexp_matches(source, 'src[01]'), false) GROUP BY 1""")
def domain_filter(read):
    kept = read("documents").where(postings.in_domain("(?i)licen[sc]e", "text") | postings.in_domain("src[01]", "source"))
    return kept.groupBy("lang").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, strftime(CASE WHEN o_orderstatus <> 'O' THEN o_orderdate::DATE ELSE DATE '2026-06-16' END, '%Y-%m-%d') AS effective_date,
CASE WHEN o_orderstatus <> 'O' THEN 'posted' ELSE 'first_seen' END AS date_source FROM orders""")
def effective_date(read):
    posted = F.when(F.col("o_orderstatus") != "O", F.to_date("o_orderdate"))
    rows = cdc.effective_date(read("orders").select("o_orderkey", posted.alias("posted_date"), F.lit("2026-06-16").cast("date").alias("first_seen_date")))
    return rows.select("o_orderkey", F.date_format("effective_date", "yyyy-MM-dd").alias("effective_date"), "date_source")


@query("""SELECT p_partkey, CASE WHEN p_name IN ('red widget', 'small ring') THEN upper(replace(p_name, ' ', '_')) WHEN p_name = 'blue ring' THEN 'SKY_RING' END AS code FROM part""")
def coerced_codes(read):
    names = {"Red widget": "RED_WIDGET", "Small ring": "SMALL_RING", "Blue ring": "SKY_RING"}
    return read("part").select("p_partkey", T.coerce_code(F.col("p_name"), names).alias("code"))


@query("""SELECT ord, o_orderpriority, count(*) AS n FROM orders JOIN (VALUES (1, '5-LOW'), (2, '3-MEDIUM'), (3, '1-URGENT'), (4, '0-NONE')) AS v(ord, p) ON o_orderpriority = p GROUP BY 1, 2""")
def ordered_categories(read):
    rows = A.ordered(read("orders"), "o_orderpriority", ["5-LOW", "3-MEDIUM", "1-URGENT", "0-NONE"])
    return rows.groupBy("ord", "o_orderpriority").agg(F.count("*").alias("n"))


@query(r"""SELECT lang_tag, count(*) AS n FROM (SELECT CASE WHEN coalesce(round(length(regexp_replace(lower(text), '[^éèêçàñóíáúäöüß]', '', 'g'))::DOUBLE
/ nullif(length(regexp_replace(lower(text), '\PL', '', 'g')), 0), 4), 0) >= 0.06 THEN 'marked' ELSE 'plain' END AS lang_tag FROM documents) GROUP BY 1""")
def language_tag(read):
    tag = F.when(T.letter_ratio(F.col("text"), "éèêçàñóíáúäöüß") >= 0.06, "marked").otherwise("plain")
    return read("documents").groupBy(tag.alias("lang_tag")).agg(F.count("*").alias("n"))


# --- boards ----------------------------------------------------------------------------------


def _board(read, path: str, *fields) -> DataFrame:
    """Pages of ten parts each, as a board answers them."""
    rows = read("part").select(F.floor(F.col("p_partkey") / 10).alias("page"), F.struct(*fields).alias("j")).groupBy("page").agg(F.array_sort(F.collect_list("j")).alias("all"))
    body = F.col("all")
    for name in reversed(path.split(".")):
        body = F.struct(body.alias(name))
    return rows.select(F.lit("q").alias("item"), F.col("page").cast("int").alias("page"), F.to_json(body).alias("payload"))


@query("""SELECT p_partkey::VARCHAR AS id, 'A ' || p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN p_brand || ', HN' ELSE 'HN' END AS place, 'Do & see' || CASE WHEN p_partkey % 3 = 0 THEN ' ' || chr(10) || 'need x y' ELSE '' END AS said,
CASE p_partkey % 4 WHEN 0 THEN '01-02-2026' WHEN 1 THEN '02-02-2026' WHEN 2 THEN '03-02-2026' END AS posted, 'sql' AS skills, 'L' || p_size AS level FROM part""")
def rest_board(read):
    k, dated = F.col("p_partkey"), lambda at, d: F.when(F.col("p_partkey") % 4 == at, F.struct(F.lit(d).alias("date")))
    pages = _board(
        read, "data", k.alias("id"), F.concat(F.lit(" A  "), "p_name").alias("title"), F.lit("<p>Do &amp; see</p>").alias("content"), F.when(k % 3 == 0, F.array(F.lit("need <b>x</b>"), F.lit("y"))).alias("requirements"),
        F.struct(F.array(F.when(k % 2 == 0, F.col("p_brand")), F.lit("HN")).alias("address_region_array")).alias("addresses"), F.array(F.lit("sql"), F.lit("")).alias("skills_arr"),
        dated(0, "01-02-2026").alias("published"), dated(1, "02-02-2026").alias("created"), dated(2, "03-02-2026").alias("refreshed"), F.concat(F.lit("L"), "p_size").alias("job_levels"),
    )
    out = boards.rest(pages, "s")
    return out.select(F.col("source_job_id").alias("id"), F.col("title_raw").alias("title"), F.col("location_raw").alias("place"), F.col("description_raw").alias("said"), F.col("posted_date_raw").alias("posted"), F.array_join("skills_raw", ",").alias("skills"), F.get_json_object("extra", "$.seniority_label").alias("level"))


@query("""SELECT p_partkey::VARCHAR AS id, CASE p_partkey % 3 WHEN 0 THEN 'Hà Nội, Huế' WHEN 1 THEN 'Hue city' ELSE 'at ' || p_brand END AS place, CASE WHEN p_partkey % 2 = 0 THEN 'https://x.example/u' ELSE 'https://b.example/a' || p_partkey || '-jv' END AS url,
'sql,py' AS skills, 'Anh' AS language FROM part""")
def search_board(read):
    k = F.col("p_partkey")
    place = lambda vi, en: F.struct(F.lit(vi).cast("string").alias("cityNameVI"), F.lit(en).cast("string").alias("cityName"))
    pages = _board(
        read, "data", k.alias("jobId"), F.col("p_name").alias("jobTitle"), F.array(F.struct(F.lit("sql").alias("skillName")), F.struct(F.lit(None).cast("string").alias("skillName")), F.struct(F.lit("py").alias("skillName"))).alias("skills"),
        F.when(k % 3 == 0, F.array(place("Hà Nội", "Hanoi"), place(None, "Huế"))).when(k % 3 == 1, F.array(place("", "Hue city"))).alias("workingLocations"), F.concat(F.lit("at "), "p_brand").alias("address"),
        F.when(k % 2 == 0, " https://x.example/u").alias("jobUrl"), F.concat(F.lit("a"), k).alias("alias"), F.lit("Anh").alias("languageSelectedVI"),
    )
    out = boards.search(pages, "s", "https://b.example")
    return out.select(F.col("source_job_id").alias("id"), F.col("location_raw").alias("place"), "url", F.array_join("skills_raw", ",").alias("skills"), F.get_json_object("extra", "$.language_req_raw").alias("language"))


@query("""SELECT p_partkey::VARCHAR AS id, coalesce(CASE WHEN p_partkey % 2 = 0 THEN 'Sub' END, 'City') AS place, 'https://b.example/' || p_partkey AS url FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0""")
def graph_board(read):
    k, named = F.col("p_partkey"), lambda c: F.struct(c.alias("name"))
    pages = _board(
        read, "data.searchJobs.jobsInPage", k.alias("id"), F.when(k % 3 == 0, "Senior Data  Engineer").otherwise("Welder").alias("title"), F.when(k % 5 == 0, named(F.lit("Business Intelligence"))).alias("hierarchicalJobCategory"),
        F.when(k % 2 == 0, named(F.lit("Sub"))).alias("citySubDivision"), named(F.lit("City")).alias("city"),
    )
    return boards.graph(pages, "s", "https://b.example", 10).select(F.col("source_job_id").alias("id"), F.col("location_raw").alias("place"), "url")


def _cards(read, card) -> DataFrame:
    rows = read("part").select(F.floor(F.col("p_partkey") / 10).alias("page"), F.struct("p_partkey", card.alias("card")).alias("j")).groupBy("page").agg(F.array_sort(F.collect_list("j")).alias("all"))
    return rows.select(F.lit("q").alias("item"), F.col("page").cast("int").alias("page"), F.concat(F.lit("<html><body><div class='list'>"), F.array_join(F.transform("all", lambda x: x["card"]), "\n"), F.lit("</div></body></html>")).alias("payload"))


@query("""SELECT p_partkey::VARCHAR AS id, p_name || ' & co' AS title, CASE WHEN p_partkey % 2 = 0 THEN 'Hybrid' END AS model, 'Ha Noi' AS place, 'sql,' || p_brand AS skills, p_partkey % 9 || ' days ago' AS posted FROM part""")
def listing_board(read):
    card = F.concat(
        F.lit('<div class="ipy-2 job-card" data-job-key="'), "p_partkey", F.lit('"><div><h3 class="x"><a href="/j">'), "p_name", F.lit(" &amp; co</a></h3></div><div class='city'>"), F.when(F.col("p_partkey") % 2 == 0, "Hybrid ").otherwise(""), F.lit("Ha Noi</div><a class='itag'>sql</a> <a class='itag'>"),
        "p_brand", F.lit("</a><span class='small-text'>"), F.col("p_partkey") % 9, F.lit(" days ago</span></div>"),
    )
    out = boards.listing(_cards(read, card), "s")
    return out.select(F.col("source_job_id").alias("id"), F.col("title_raw").alias("title"), F.get_json_object("extra", "$.work_model").alias("model"), F.col("location_raw").alias("place"), F.array_join("skills_raw", ",").alias("skills"), F.col("posted_date_raw").alias("posted"))


@query("""SELECT p_partkey::VARCHAR AS id, p_name AS title, '/j/' || p_partkey AS url, p_brand AS company, CASE WHEN p_partkey % 2 = 0 THEN 'Huế' END AS place FROM part""")
def card_board(read):
    kind = F.when(F.floor(F.col("p_partkey") / 10) % 2 == 0, "job-item-2").otherwise("other")
    card = F.concat(
        F.lit('<div class="'), kind, F.lit('" data-job-id="'), "p_partkey", F.lit('"><div class="in"><h3 class="title"><a href="/j/'), "p_partkey", F.lit('"> <span>'), "p_name", F.lit('</span></a></h3></div><a class="company">'), "p_brand", F.lit("</a>"),
        F.when(F.col("p_partkey") % 2 == 0, '<label class="address">Huế</label>').otherwise(""), F.lit("</div>"),
    )
    out = boards.cards(_cards(read, card), "s")
    return out.select(F.col("source_job_id").alias("id"), F.col("title_raw").alias("title"), "url", F.col("company_raw").alias("company"), F.col("location_raw").alias("place"))


@query("""SELECT 's' AS source, count(*) AS postings, 100.0::DOUBLE AS described, count(DISTINCT p_partkey // 10) AS pages,
(SELECT string_agg(c, '; ' ORDER BY n DESC, c) FROM (SELECT p_brand || ', HN' AS c, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, c LIMIT 5)) AS top_locations FROM part""")
def run_stats(read):
    pages = _board(read, "data", F.col("p_partkey").alias("id"), F.lit("x").alias("content"), F.struct(F.array("p_brand", F.lit("HN")).alias("address_region_array")).alias("addresses"))
    return boards.run_stats(boards.rest(pages, "s"))
