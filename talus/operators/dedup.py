"""Greedy fuzzy dedup within blocks, and work once for equal content."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 90.0


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit rows."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        m = where.get(c, 0)
        u = row & m
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def _ratio(a: str, b: str) -> float:
    return 200.0 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """Similarity 0 to 100 of two texts as sets of words; an empty text is like nothing."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    best = _ratio(one, two)
    return max(best, _ratio(both, one), _ratio(both, two)) if both else best


def fuzzy(df: DataFrame, key: str, block: str, city: str, title: str, order: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``is_duplicate_of``: the first earlier survivor of the same block and city
    (null equals null) whose title is alike; duplicates never become survivors.

    Only rows of one block and one city can match, so both together are the group; rows without a
    block pass by.  Equal titles of a group are decided once, by their first row: a group's task
    sees each distinct title once, however many rows hold it.
    """

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[tuple[str, str]] = []
        out = []
        pdf = pdf.sort_values(["__place", "__first"], kind="stable")
        for k, t in zip(pdf["__first"], pdf["__title"]):
            hit = next((i for i, s in kept if token_set_ratio(t, s) >= threshold), None)
            if hit is None:
                kept.append((k, t))
            out.append(hit)
        return pdf[["__block", "__city", "__title", "__first"]].assign(__hit=out)

    place = F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("9999")) for c in order])
    rows = df.where((F.col(block) != "") & F.col(block).isNotNull()).select(F.col(key).alias("__key"), F.col(block).alias("__block"), F.col(city).alias("__city"), F.coalesce(title, F.lit("")).alias("__title"), place.alias("__order"))
    rows = rows.where(F.rlike("__title", F.lit(r"(?U)[^\s\x1c-\x1f]")))  # a title without words is like nothing
    kinds = {c: t for c, t in rows.dtypes}
    first = rows.groupBy("__block", "__city", "__title").agg(F.min(F.struct("__order", "__key")).alias("f")).select("__block", "__city", "__title", F.col("f.__order").alias("__place"), F.col("f.__key").alias("__first"))
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("__block", "__city", "__title")) + f", __first {kinds['__key']}, __hit {kinds['__key']}"
    said = first.groupBy("__block", "__city").applyInPandas(greedy, schema).alias("s")
    r = rows.alias("r")
    on = (F.col("r.__block") == F.col("s.__block")) & F.col("r.__city").eqNullSafe(F.col("s.__city")) & (F.col("r.__title") == F.col("s.__title"))
    dup = F.coalesce("s.__hit", F.when(F.col("r.__key") != F.col("s.__first"), F.col("s.__first")))
    found = r.join(said, on).select(F.col("r.__key").alias("__key"), dup.alias("__dup")).where("__dup is not null")
    return df.join(found, F.col(key) == F.col("__key"), "left").withColumn("is_duplicate_of", F.col("__dup")).drop("__key", "__dup")


def representatives(df: DataFrame, content: str, key: str) -> DataFrame:
    """The row with the least key of each content: what a dear step should see."""
    low = df.groupBy(content).agg(F.min(key).alias(key))
    return df.join(low, [content, key], "left_semi")


def fan_out(df: DataFrame, labelled: DataFrame, content: str, columns: list[str]) -> DataFrame:
    """Results of representatives joined back to all rows of their content."""
    return df.join(labelled.select(content, *columns), content, "left")
