"""Change-tracked master and observation tables without MERGE.

``step`` merges one batch by a full outer join on the key; ``replay`` derives the same state
from the observation log in closed form, for runs that arrive in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Runs that a row of a streak source may miss before it is retired.
RETIRE = 2
STATE = ["posted_date", "first_seen_date", "last_seen_date", "is_active", "removed_date", "miss_streak", "last_streak_run"]


def first_wins(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def step(master: DataFrame, batch: DataFrame, keys: list[str], raw: list[str], run: str, source: str, full_scan: bool) -> DataFrame:
    """The master after one source's batch (one row a key) of the run date ``run``.

    Raw fields are overwritten even by null; ``posted_date`` keeps its first value.  Rows that a
    full-scan source lacks are removed at once, others after RETIRE missed runs, one a run date.
    An empty batch changes nothing.
    """
    if batch.isEmpty():
        return master
    day = F.lit(run).cast("date")
    b = batch.select(*keys, "posted_date", *raw).withColumn("__in", F.lit(True))
    j = master.alias("m").join(b.alias("b"), keys, "full_outer")
    seen, known = F.col("b.__in").isNotNull(), F.col("m.first_seen_date").isNotNull()
    missed = known & ~seen & (F.col(source) == batch.select(source).first()[0]) & F.col("m.is_active") & (F.col("m.last_seen_date") < day)
    again = missed & F.coalesce(F.col("m.last_streak_run") != day, F.lit(True))
    streak = F.when(seen, F.lit(0)).when(again, F.col("m.miss_streak") + 1).otherwise(F.col("m.miss_streak"))
    gone = missed if full_scan else missed & (streak >= RETIRE)
    return j.select(
        *keys,
        *[F.when(seen, F.col(f"b.{c}")).otherwise(F.col(f"m.{c}")).alias(c) for c in raw],
        F.coalesce("m.posted_date", F.when(seen, F.col("b.posted_date"))).alias("posted_date"),
        F.coalesce("m.first_seen_date", day).alias("first_seen_date"),
        F.when(seen, day).otherwise(F.col("m.last_seen_date")).alias("last_seen_date"),
        F.when(seen, True).when(gone, False).otherwise(F.col("m.is_active")).alias("is_active"),
        F.when(seen, None).when(gone, day).otherwise(F.col("m.removed_date")).cast("date").alias("removed_date"),
        (F.when(seen, 0).otherwise(F.col("m.miss_streak")) if full_scan else streak).cast("int").alias("miss_streak"),
        F.when(F.lit(not full_scan) & again, day).otherwise(F.col("m.last_streak_run")).alias("last_streak_run"),
    )


def observe(log: DataFrame, batch: DataFrame, keys: list[str], run: str) -> DataFrame:
    """The log with the batch's keys of a run date; repeated runs add nothing."""
    new = batch.select(*keys).distinct().withColumn("snapshot_date", F.lit(run).cast("date"))
    return log.unionByName(new.join(log, [*keys, "snapshot_date"], "left_anti"))


def replay(log: DataFrame, keys: list[str], source: str, full_scan: Column, at: str = "snapshot_date") -> DataFrame:
    """first/last seen, activity, removal and streak of every key from the log of in-order runs."""
    runs = log.select(source, at).distinct().withColumn("__no", F.row_number().over(Window.partitionBy(source).orderBy(at)))
    calendar = runs.groupBy(source).agg(F.max("__no").alias("__runs"))
    key = log.groupBy(*keys).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"))
    k = key.join(runs.withColumnRenamed(at, "last_seen"), [source, "last_seen"]).join(calendar, source)
    missed = F.col("__runs") - F.col("__no")
    need = F.when(full_scan, 1).otherwise(RETIRE)
    ended = runs.select(source, F.col("__no").alias("__end"), F.col(at).alias("removed"))
    k = k.withColumns({"__missed": missed, "__end": F.when(missed >= need, F.col("__no") + need)})
    return k.join(ended, [source, "__end"], "left").select(
        *keys, "first_seen", "last_seen", F.col("removed").isNull().alias("is_active"), "removed",
        F.when(full_scan, F.lit(0)).otherwise(F.least("__missed", F.lit(RETIRE))).cast("long").alias("miss_streak"),
    )


def effective_date(df: DataFrame) -> DataFrame:
    """The posted date, else the first sighting, and which of them it is."""
    return df.withColumns({"effective_date": F.coalesce("posted_date", "first_seen_date"), "date_source": F.when(F.col("posted_date").isNotNull(), "posted").otherwise("first_seen")})


def update_from(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Matched rows take the source's values, nulls included; the others keep theirs."""
    s = source.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__hit"))
    j = target.join(s, F.col(key) == F.col("__key"), "left")
    new = {c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}
    return j.withColumns(new).select(*target.columns)


def carry_forward(now: DataFrame, before: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Blank fields (null, empty text or list) are restored from the previous version by key."""
    kinds = dict(now.dtypes)
    b = before.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    blank = lambda c: F.col(c).isNull() | ((F.size(c) == 0) if kinds[c].startswith("array") else (F.col(c) == ""))
    j = now.join(b, F.col(key) == F.col("__key"), "left")
    return j.withColumns({c: F.when(blank(c), F.coalesce(f"__{c}", c)).otherwise(F.col(c)) for c in columns}).select(*now.columns)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace old ones of their key; the rest stay."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def insert_missing(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows of unknown keys are added; known keys keep their row."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def fill_details(now: DataFrame, details: DataFrame, key: str, fill: list[str], extra: str, always: list[str]) -> DataFrame:
    """Rows with details by key: columns of ``fill`` only where blank (and the detail is not), keys of the
    map ``extra`` named in ``always`` overwritten in every matched row, by null too.  ``details`` has
    one row a key, with the columns of both lists."""
    kinds = dict(now.dtypes)
    blank = lambda c, k: F.col(c).isNull() | ((F.size(c) == 0) if k.startswith("array") else (F.col(c) == ""))
    d = details.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in (*fill, *always)], F.lit(True).alias("__hit"))
    j = now.join(d, F.col(key) == F.col("__key"), "left")
    new = {c: F.when(blank(c, kinds[c]) & ~blank(f"__{c}", kinds[c]), F.col(f"__{c}")).otherwise(F.col(c)) for c in fill}
    rest = F.map_filter(F.coalesce(extra, F.expr("map()").cast(kinds[extra])), lambda k, _: ~k.isin(always))
    put = F.map_from_arrays(F.array(*map(F.lit, always)), F.array(*[F.col(f"__{c}").cast("string") for c in always]))
    return j.withColumns(new | {extra: F.when(F.col("__hit"), F.map_concat(rest, put)).otherwise(F.col(extra))}).select(*now.columns)
