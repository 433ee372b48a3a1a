"""URL filter (native): rules first, else logistic regression on hashed character n-grams.

The model is fitted by ``pyspark.ml`` on a small labelled table of URLs (a parameter) and
applied as a sum of weights over the URL's n-gram buckets, inside the scan's own stage.
"""

from __future__ import annotations

import random
from functools import lru_cache

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SIZES = (3, 4, 5)
BUCKETS = 2048
#: Strength of the ridge penalty; probability from which the method blocks.
REG, THRESHOLD = 0.003, 0.5

# Fixed values of the contract: rule (host and path), verdict.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

#: Words of which the default labelled table is made: (block, allow).
SEED_WORDS = (
    (
        "spam-farm", "cheap-pills", "casino-bonus", "free-loans", "adult-cams", "win-prizes", "fake-watches", "click-bait", "torrent-warez", "pills-online",
        "viagra-shop", "online-casino", "poker-win", "slots-jackpot", "sports-betting", "payday-loan", "hot-singles", "xxx-videos", "sex-chat", "porn-tube",
        "escort-girls", "replica-bags", "cracked-software", "keygen-download", "serial-crack", "get-rich-quick", "miracle-diet", "weight-loss-pills", "bitcoin-doubler", "crypto-giveaway",
        "free-iphone", "lottery-winner", "buy-followers", "seo-backlinks", "cheap-meds", "cialis-price", "nude-pics", "bet-now", "gambling-tips", "roulette-bonus",
        "ad-server", "banner-click", "popup-ads", "click-tracker", "track-visitors", "bets-online", "phishing-login", "account-verify-login", "hacked-accounts", "warez-full", "download-free-full-crack", "mega-jackpot", "cash-advance", "loan-approval-fast", "dating-sluts", "spam-blog",
    ),
    (
        "blog", "news", "museum", "library", "garden", "recipes", "science", "travel-notes", "school", "city-archive",
        "university", "research", "journal", "encyclopedia", "docs", "wiki", "forum", "weather", "history", "gazette",
        "hospital", "council", "open-data", "cooking", "gardening", "photography", "mathematics", "physics", "philosophy", "literature",
        "chess-club", "football-results", "music-review", "film-review", "bookshop", "theatre", "orchestra", "parliament", "ministry", "foundation",
        "software-manual", "developer-guide", "open-source", "tutorial", "lecture-notes", "field-guide", "bird-watching", "cycling", "hiking", "local-news",
    ),
)
SEED_FORMS = (
    "http://{}.org/en/12", "https://www.{}.net/de/345.html", "https://{}.example.org/fr/6?page=2", "http://m.{}.io/", "https://shop.{}.info/a/b", "https://my.site.com/{}/2024/index.html", "http://a1.xyz/c/{}-12", "https://{}24.biz",
    "https://blog.{}.example.net/en/70/", "http://{}.example.com/es/8.html",
)
#: Hosts that say nothing are allowed: so many words of such syllables, by a fixed generator.
NEUTRAL, SYLLABLES = 300, "an be co da el fi go ha in ja ko li ma no or pe qui ra so ti un ve wo ya zu ber cor den fal gan hil kin lan mer nor pol ran sil ton ver wen".split()


#: Labelled URLs that the model is fitted on, at most: of a larger table a sample by hash.
FIT_ROWS = 10_000


def labelled(spark: SparkSession) -> DataFrame:
    """The default labelled table: url, label (1: block), every seed word and neutral word in every form."""
    draw = random.Random(42)
    neutral = ["".join(draw.choices(SYLLABLES, k=draw.randint(2, 4))) for _ in range(NEUTRAL)]
    rows = [(form.format(w), bad) for bad, words in ((1.0, SEED_WORDS[0]), (0.0, SEED_WORDS[1] + tuple(neutral))) for w in words for form in SEED_FORMS]
    return spark.createDataFrame(rows, "url string, label double")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; null url or no ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def buckets(text: Column) -> Column:
    """Buckets of the character n-grams, repeats included."""

    def grams(chars: Column, n: int) -> Column:
        at = lambda i, k: F.get(chars, i + k)
        found = F.transform(F.sequence(F.lit(0), F.size(chars) - n), lambda i: F.concat(*[at(i, k) for k in range(n)]))
        return F.when(F.size(chars) >= n, found).otherwise(F.array().cast("array<string>"))

    # the text is split into its characters once, so that a long one is walked and not searched anew for each n-gram
    every = F.transform(F.array(F.split(text, "")), lambda chars: F.concat(*[grams(chars, n) for n in SIZES]))[0]
    return F.transform(every, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int"))


@lru_cache(maxsize=4)
def _fit(rows: tuple[tuple[str, float], ...]) -> tuple[float, tuple[float, ...]]:
    if not rows:  # nothing learned: nothing is blocked
        return -20.0, (0.0,) * BUCKETS
    spark = SparkSession.active()
    table = spark.createDataFrame(list(rows), "url string, label double")
    host, path = host_and_path(F.col("url"))
    share = sum(y for _, y in rows) / max(1, len(rows))
    weight = F.when(F.col("label") == 1, 0.5 / max(share, 1e-3)).otherwise(0.5 / max(1 - share, 1e-3))  # both labels count alike
    hits = table.select("label", weight, F.array_sort(F.array_distinct(buckets(F.concat(host, path))))).collect()  # FIT_ROWS at most
    found = spark.createDataFrame([(y, w, Vectors.sparse(BUCKETS, b, [1.0] * len(b))) for y, w, b in hits], ["label", "weight", "features"])
    model = LogisticRegression(regParam=REG, maxIter=60, standardization=False, weightCol="weight").fit(found.coalesce(1))
    return float(model.intercept), tuple(round(float(x), 9) for x in model.coefficients.toArray())


def fit(table: DataFrame) -> tuple[float, tuple[float, ...]]:
    """Intercept and bucket weights from (url, label); of a table of more than FIT_ROWS rows, the
    FIT_ROWS whose url and label have the least hashes.

    Rows with a null label are left out; a null url counts as empty.
    """
    rows = table.select(F.coalesce("url", F.lit("")).alias("url"), "label").where("label is not null")
    rows = rows.orderBy(F.xxhash64("url", "label"), "url", "label").limit(FIT_ROWS).collect()
    return _fit(tuple(sorted((r[0], r[1]) for r in rows)))


def probability(text: Column, model: tuple[float, tuple[float, ...]]) -> Column:
    weights = F.expr("array(" + ",".join(f"{w!r}D" for w in model[1]) + ")")
    score = F.aggregate(F.array_distinct(buckets(text)), F.lit(model[0]), lambda acc, b: acc + F.get(weights, b))
    return 1 / (1 + F.exp(-score))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest fitting rule's (rule, verdict), or null.  No two rules of one length fit a URL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, table: DataFrame | None = None, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """A row for each page: page_id, host, path, rule, verdict, p_block.

    A null or malformed url has an empty host and path, fits no rule and is judged by the
    method like any other; repeated rows get a row each, an empty table none.  The time is linear
    in the length of a url; further columns, whatever their names, play no part.
    """
    model = fit(labelled(pages.sparkSession) if table is None else table)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumns({"__rule": rule_for(F.col("host"), F.col("path"), rules), "p_block": F.round(probability(F.concat("host", "path"), model), 6)})
    own = F.when(F.col("p_block") >= THRESHOLD, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("__rule.rule").alias("rule"), F.coalesce("__rule.verdict", own).alias("verdict"), "p_block")
