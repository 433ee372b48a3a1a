"""Labels by tiers: title rules, prototype vectors, a pluggable judge; with KPIs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.operators.aggregates import agreement, facets, rate, right_closed, stratified
from talus.operators.dedup import fan_out, representatives

#: Confidence gates: rule, similarity and margin of the vector tier, judge.
RULE, SIMILARITY, MARGIN, JUDGE = 0.9, 0.82, 0.02, 0.6
VOTE = "array<struct<judge:string,job_family:string,confidence:double>>"
Judge = Callable[[str], tuple[str | None, float, str]]


def tiers(df: DataFrame, rule_code: Column, vector_code: Column, similarity: Column, margin: Column, alias: Column | None = None) -> DataFrame:
    """code, confidence, method and reasoning of the local tiers; null where neither gate opens.

    ``alias`` is what the rule found; the reasoning names it, or the similarity and its margin.
    """
    by_vector = (similarity >= SIMILARITY) & (F.coalesce(margin, F.lit(1.0)) >= MARGIN)
    pick = lambda rule, vector: F.when(rule_code.isNotNull(), rule).when(by_vector, vector)
    return df.withColumns({
        "code": pick(rule_code, vector_code), "confidence": pick(F.lit(RULE), F.bround(similarity, 3)), "method": pick(F.lit("rule"), F.lit("embedding")),
        "reasoning": pick(F.format_string("title alias '%s'", F.coalesce(rule_code if alias is None else alias, F.lit(""))), F.format_string("embed sim %.2f (margin %.2f)", similarity, F.coalesce(margin, F.lit(1.0)))),
    })


def judged(df: DataFrame, content: str, text: str, key: str, judge: Judge, name: str, cache: DataFrame | None = None) -> DataFrame:
    """The judge's answers by content: cached ones first, the rest asked once for each content.

    The judge runs in ``mapInPandas`` and must be free of side effects; a paid service is asked
    from the driver instead (``dispatch``) and its answers arrive as ``cache``.
    """
    open_ = representatives(df, content, key)
    if cache is not None:
        cache = first_answers(cache, content)
        open_ = open_.join(cache.select(content), content, "left_anti")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            said = [judge(t or "") for t in p["__text"]]
            yield pd.DataFrame({content: p[content], "code": [s[0] for s in said], "confidence": [float(s[1]) for s in said], "reasoning": [s[2][:300] for s in said], "judge": name})

    schema = f"{content} string, code string, confidence double, reasoning string, judge string"
    new = open_.select(content, F.col(text).alias("__text")).mapInPandas(run, schema)
    return new if cache is None else new.unionByName(cache.select(*new.columns))


def first_answers(cache: DataFrame, content: str, order: list[str] | None = None) -> DataFrame:
    """One cached answer a content: of the first judge in ``order`` (judges not named come last, by
    name) that has a whole one.  Rows without a code or a judge are torn and count as not there."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("judge")) if order else F.lit(0)
    whole = cache.where(F.col("code").isNotNull() & F.col("judge").isNotNull() & F.col("confidence").isNotNull())
    first = F.struct((place == 0).alias("other"), place.alias("at"), "judge", "confidence", "code")
    rest = [c for c in cache.columns if c != content]
    return whole.groupBy(content).agg(F.min_by(F.struct(*rest), first).alias("a")).select(content, "a.*").select(*cache.columns)


def label(df: DataFrame, content: str, text: str, key: str, judge: Judge, name: str, taxonomy: DataFrame, cache: DataFrame | None = None, version: str = "v1") -> DataFrame:
    """The whole cascade after ``tiers``: only the remainder, once for each content, is judged.

    Answers under the judge's gate keep their code and go to manual review; without an answer a row is
    OTHER with no confidence, failed.  The taxonomy (one row a code) adds domain and subdomain.
    """
    done = df.where(F.col("code").isNotNull()).withColumn("judge", F.lit(None).cast("string"))
    rest = df.where(F.col("code").isNull())
    said = judged(rest, content, text, key, judge, name, cache)
    rest = fan_out(rest.drop("code", "confidence", "method", "reasoning"), said, content, ["code", "confidence", "reasoning", "judge"])
    fine, failed = F.coalesce(F.col("confidence") >= JUDGE, F.lit(False)), F.col("code").isNull()
    rest = rest.withColumns({
        "method": F.when(F.col("judge").isNull(), "manual_review").when(failed, "failed").otherwise(F.concat(F.lit("llm:"), "judge")), "__fine": fine & ~failed,
        "reasoning": F.when(failed, F.concat("judge", F.lit(" failed"))).otherwise(F.col("reasoning")), "confidence": F.when(failed, 0.0).otherwise(F.col("confidence")),
        "judge": F.when(~failed, F.col("judge")), "code": F.coalesce("code", F.lit("OTHER")),
    })
    done = done.withColumn("__fine", F.lit(True))
    both = done.unionByName(rest.select(*done.columns))
    votes = F.when(F.col("judge").isNotNull(), F.array(F.struct("judge", F.col("code").alias("job_family"), "confidence"))).otherwise(F.array().cast(VOTE))
    out = both.select(
        key, F.col("code").alias("job_family"), F.bround("confidence", 3).alias("confidence_score"),
        F.col("method").alias("labeling_method"), F.to_json(votes).alias("llm_votes"), F.substring("reasoning", 1, 300).alias("reasoning"),
        F.when(F.col("__fine"), "resolved").otherwise("manual_review").alias("review_status"), F.lit(version).alias("taxonomy_version"),
    )
    dim = taxonomy.select(F.col("code").alias("job_family"), "domain", "subdomain")
    return out.join(dim, "job_family", "left")


def kpis(labels: DataFrame) -> DataFrame:
    """One row: coverage, manual review and OTHER rates, agreement of the first two votes."""
    votes = F.from_json("llm_votes", VOTE)
    codes = F.transform(votes, lambda v: v["job_family"])
    return labels.agg(
        F.count("*").alias("n"),
        rate(F.col("job_family").isNotNull()).alias("coverage"),
        rate(F.col("review_status") == "manual_review").alias("manual_rate"),
        rate(F.col("job_family") == "OTHER").alias("other_rate"),
        F.bround(100 * F.avg(agreement(codes)), 1).alias("agreement"),
        F.count_if(F.startswith("labeling_method", F.lit("llm"))).alias("n_judged"),
    )


def distributions(labels: DataFrame) -> DataFrame:
    """(facet, value, n) of methods, families, domains (but OTHER's) and confidence bins."""
    rows = labels.select("labeling_method", "job_family", F.when(F.col("job_family") != "OTHER", F.col("domain")).alias("domain"), _bin().alias("confidence"))
    return facets(rows, "labeling_method", "job_family", "domain", "confidence")


def spot_check(labels: DataFrame, texts: DataFrame, key: str, title: str, n: int = 40, seed: int = 42) -> DataFrame:
    """A stratified sample of about ``n`` labels, at least one a family, with titles (null where there
    is none) and an empty column for the human's answer."""
    families = max(1, labels.select("job_family").distinct().count())
    some = stratified(labels, "job_family", key, max(1, n // families), seed)
    rows = some.join(texts.select(key, title), key, "left")
    return rows.select(key, title, "job_family", "confidence_score", "labeling_method", "review_status", F.lit("").alias("human_family"))


def confidence_bins(labels: DataFrame) -> DataFrame:
    return labels.groupBy(_bin().alias("bin")).agg(F.count("*").alias("n"))


def _bin() -> Column:
    return right_closed(F.col("confidence_score"), [0.0, 0.5, 0.66, 0.85, 1.01], ["<0.5", "0.5-0.66", "0.66-0.85", "0.85-1.0"])
