"""Share tables, cross grains, pairs, trends, rates and bins.

Denominators are taken before rows are exploded or dropped, so entities without items count.
Percentages are half-even (``exact=False``: half-up, as SQL's round).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, places: int = 1, exact: bool = True) -> Column:
    return (F.bround if exact else F.round)(F.lit(100.0) * part / whole, places)


def items(df: DataFrame, array: str, item: str) -> DataFrame:
    """One row for each element; empty and null lists and null elements vanish."""
    return df.withColumn(item, F.explode(array)).drop(array).na.drop(subset=[item])


def share(df: DataFrame, entity: str, keys: list[str], within: list[str] | None = None, whole: DataFrame | None = None, places: int = 1, exact: bool = True) -> DataFrame:
    """Distinct entities by ``keys`` and their share of the entities of ``whole`` (default ``df``),
    over all or within the key prefix ``within``.  Rows of null keys are left out of the groups."""
    within = within or []
    base = df if whole is None else whole
    n = df.na.drop(subset=keys).groupBy(*keys).agg(F.count_distinct(entity).alias("n"))
    if within:
        total = base.groupBy(*within).agg(F.count_distinct(entity).alias("total"))
        out = n.join(total, within)
    else:
        out = n.crossJoin(F.broadcast(base.agg(F.count_distinct(entity).alias("total"))))  # one row
    return out.select(*keys, "n", percent(F.col("n"), F.col("total"), places, exact).alias("pct"))


def cross(df: DataFrame, entity: str, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys).groupBy(*keys).agg(F.count_distinct(entity).alias("n"))


def pairs(df: DataFrame, entity: str, item: str) -> DataFrame:
    """Unordered pairs of an entity's distinct items, and how many entities have both.

    An entity's items meet in one sorted array, so its pairs are made in place; the array holds an
    entity's distinct items only.
    """
    lists = df.na.drop(subset=[item]).groupBy(entity).agg(F.array_sort(F.collect_set(item)).alias("all"))
    first = lists.select("all", F.posexplode("all").alias("at", "item_a"))
    both = first.select("item_a", F.explode(F.slice("all", F.col("at") + 2, F.size("all"))).alias("item_b"))
    return both.groupBy("item_a", "item_b").agg(F.count("*").alias("n"))


def trend(observed: DataFrame, entity: str, at: str, key: str) -> DataFrame:
    return cross(observed, entity, [at, key])


def filtered_counts(df: DataFrame, by: list[str], **conditions: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in conditions.items()])


def rate(condition: Column, places: int = 1, exact: bool = True) -> Column:
    return (F.bround if exact else F.round)(100 * F.avg(condition.cast("int")), places)


def right_closed(value: Column, edges: list[float], labels: list[str]) -> Column:
    """The label of the bin; bins are right-closed, the lowest edge belongs to the first bin."""
    out = F.lit(None).cast("string")
    for hi, label in reversed(list(zip(edges[1:], labels))):
        out = F.when(value <= hi, label).otherwise(out)
    return F.when((value >= edges[0]) & (value <= edges[-1]), out)


def mode_by(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The most frequent value of each group, the lowest on ties, by counts (no value lists)."""
    n = df.na.drop(subset=[value]).groupBy(*by, value).agg(F.count("*").alias("n"))
    return n.groupBy(*by).agg(F.min_by(value, F.struct((-F.col("n")).alias("n"), value)).alias(value))


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    return df.groupBy(row).pivot(column, values).count().na.fill(0)


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each column: its share of null or falsy (empty, zero) values."""
    kinds = dict(df.dtypes)
    empty = {"string": "", "boolean": False}
    bad = [F.col(c).isNull() | (F.size(c) == 0 if kinds[c].startswith("array") else F.col(c) == empty.get(kinds[c], 0)) for c in columns]
    rates = df.agg(*[F.round(100 * F.avg(F.coalesce(b, F.lit(True)).cast("int")), 1).alias(c) for b, c in zip(bad, columns)])
    return rates.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("null_rate")) for c in columns])).alias("x")).select("x.*")


def top(df: DataFrame, k: int, by: str = "n", *tiebreak: str) -> DataFrame:
    return df.orderBy(F.desc(by), *tiebreak).limit(k)


def stratified(df: DataFrame, by: str, key: str, per: int, seed: int = 42) -> DataFrame:
    """``per`` rows of each stratum in the order of md5(seed:key): a sample that any engine repeats."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(by).orderBy(order, key))).where(F.col("rn") <= per).drop("rn")


def agreement(votes: Column) -> Column:
    """1 if the first two votes agree, 0 if not, null with fewer than two."""
    return F.when(F.size(votes) >= 2, (F.get(votes, F.lit(0)) == F.get(votes, F.lit(1))).cast("int"))


def terms(tokens: Column) -> Column:
    """Unigrams and bigrams of a token list (bigrams are formed of the tokens that are left)."""
    pairs_ = F.transform(F.sequence(F.lit(1), F.size(tokens) - 1), lambda i: F.concat_ws(" ", F.get(tokens, i - 1), F.get(tokens, i)))
    return F.when(F.size(tokens) > 1, F.concat(tokens, pairs_)).otherwise(tokens)


def catalog_text(df: DataFrame, by: str, name: str, order: str, last: str = "OTHER") -> DataFrame:
    """Names of a group joined by ``; `` in order, ``last`` at the end."""
    rows = F.array_sort(F.collect_list(F.struct((F.col(name) == last).alias("end"), F.col(order).alias("at"), F.col(name).alias("name"))))
    return df.groupBy(by).agg(F.concat_ws("; ", F.transform(rows, lambda x: x["name"])).alias("names"))


def ordered(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows of the listed values with their place in the list (ord); the other rows go."""
    place = F.array_position(F.array(*map(F.lit, values)), F.col(column))
    return df.withColumn("ord", place.cast("int")).where("ord > 0")


def levels(df: DataFrame, *keys: str) -> DataFrame:
    """Counts of every prefix of ``keys`` and of all rows; ``level`` is the grouping id."""
    return df.rollup(*keys).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def core_counts(df: DataFrame, entity: str, item: str, core: list, least: int = 2) -> DataFrame:
    """One row: entities with ``least`` or more distinct items of ``core``, and all entities."""
    held = df.groupBy(entity).agg(F.count_distinct(F.when(F.col(item).isin(core), F.col(item))).alias("held"))
    return held.agg(F.count_if(F.col("held") >= least).alias("multi"), F.count("*").alias("n"))


def facets(df: DataFrame, *columns: str) -> DataFrame:
    """(facet, value, n): how often each value of each column occurs, nulls left out; all columns in one pass."""
    each = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(each).alias("x")).select("x.*").na.drop().groupBy("facet", "value").agg(F.count("*").alias("n"))


def overview(df: DataFrame, active: str, *columns: str) -> DataFrame:
    """``facets`` of a corpus, with its rows and its active rows (null counts as no)."""
    sums = df.agg(F.count("*").alias("rows"), F.count_if(F.coalesce(F.col(active), F.lit(False))).alias("active"))
    both = sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.lit("").alias("value"), F.col(c).alias("n")) for c in ("rows", "active")])).alias("x")).select("x.*")
    return both.unionByName(facets(df, *columns))


def evidence(df: DataFrame, text: str, scope: str, **kinds: str) -> DataFrame:
    """One row: texts that match the pattern ``scope``, of these those of each kind's pattern (they may
    overlap) and ``neither``, those of no kind."""
    hit = lambda p: F.coalesce(F.col(text).rlike(p), F.lit(False))
    said = {k: hit(p) for k, p in kinds.items()}
    none = F.lit(True)
    for c in said.values():
        none = none & ~c
    return df.where(hit(scope)).agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in said.items()], F.count_if(none).alias("neither"))


def profile(df: DataFrame, by: str, values: list[str], mean: str, places: int = 3) -> DataFrame:
    """A row for each group: its size, the mode of each of ``values`` and the mean of ``mean``."""
    out = df.groupBy(by).agg(F.count("*").alias("n"), F.round(F.avg(mean), places).alias(f"mean_{mean}"))
    for v in values:
        out = out.join(mode_by(df, [by], v).withColumnRenamed(v, f"top_{v}"), by, "left")
    return out


def first_pages(df: DataFrame, key: str, n: int, page: str = "page", order: tuple[str, ...] = ("page", "pos"), pages: int = 3) -> DataFrame:
    """The first ``n`` rows of distinct keys from the first ``pages`` pages, in order of appearance
    (a page is read only while fewer keys are known)."""
    place = F.struct(*order)
    firsts = df.where(F.col(page) <= pages).groupBy(key).agg(F.min(place).alias("__at")).orderBy("__at").limit(n)
    return df.withColumn("__at", place).join(F.broadcast(firsts), [key, "__at"], "left_semi").drop("__at")  # n rows
