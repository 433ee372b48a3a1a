"""Prototype matching and clustering over unit vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def prototypes(df: DataFrame, label: str, vector: str) -> DataFrame:
    """The mean vector of each label, element by element: no lists of vectors are gathered."""
    rows = df.where(F.col(label).isNotNull()).select(label, F.posexplode(vector).alias("at", "v"))
    means = rows.groupBy(label, "at").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("prototype"))


def text_prototypes(families: DataFrame, encoder: Callable[[list[str]], np.ndarray], prefix: str = "passage: ") -> DataFrame:
    """(label, prototype) of each family but OTHER, from its own words: ``name``, ``aliases`` and
    ``skills`` of its ``code``, encoded as one text."""
    said = F.concat(F.col("name"), F.lit(". "), F.concat_ws(", ", F.concat("aliases", "skills")))
    rows = families.where("code <> 'OTHER'").select(F.col("code").alias("label"), said.alias("text"))
    return embed(rows, "label", "text", encoder, prefix).withColumnRenamed("vector", "prototype")


def match(df: DataFrame, protos: DataFrame, label: str, vector: str, least: float, margin: float) -> DataFrame:
    """Best prototype, its similarity and its margin over the second; ``accepted`` by both gates.

    The prototypes (one a label of the taxonomy, a table that does not grow with the data) are gathered
    into one array, so that each row is scored in place.
    """
    table = protos.agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), "prototype"))).alias("__protos"))
    scored = df.crossJoin(F.broadcast(table)).withColumn(  # one row
        "__s", F.array_sort(F.transform("__protos", lambda p: F.struct((-dot(F.col(vector), p["prototype"])).alias("neg"), p["label"].alias("label"))))
    )
    top, second = F.get("__s", F.lit(0)), F.get("__s", F.lit(1))
    out = scored.withColumns({"best": top["label"], "similarity": -top["neg"], "margin": second["neg"] - top["neg"]}).drop("__s", "__protos")
    return out.withColumn("accepted", (F.col("similarity") >= least) & (F.coalesce("margin", F.lit(1.0)) >= margin))


def embed(df: DataFrame, key: str, text: str, encoder: Callable[[list[str]], np.ndarray], prefix: str = "passage: ") -> DataFrame:
    """Unit vectors by a pluggable encoder; equal texts are encoded once."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            v = np.asarray(encoder([prefix + t for t in p["__text"]]), np.float32)
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            yield pd.DataFrame({"__text": p["__text"], "vector": list(v)})

    once = df.select(F.coalesce(text, F.lit("")).alias("__text")).distinct().mapInPandas(run, "__text string, vector array<float>")
    return df.select(key, F.coalesce(text, F.lit("")).alias("__text")).join(once, "__text").drop("__text")


def hashing_encoder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A deterministic encoder without a model: signed hashed words."""

    def encode(texts: list[str]) -> np.ndarray:
        import zlib

        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = zlib.crc32(w.encode())
                out[i, h % dim] += 1 if h >> 16 & 1 else -1
        return out

    return encode


#: The k that are tried over all rows, and over a part of them; starts of each.
K_ALL, K_PART, STARTS = (8, 12, 16, 20), (4, 6, 8, 10), tuple(range(42, 52))


def cluster(df: DataFrame, vector: str, ks: tuple[int, ...] = K_ALL, seeds: tuple[int, ...] = STARTS) -> tuple[KMeansModel, int] | None:
    """The k of the best silhouette (first on ties), each k by its cheapest start;
    a k that is not below the number of rows is left out; None if none is left."""
    rows = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features")).persist()
    try:
        n, best = rows.count(), None
        for k in ks:
            if k >= n:
                continue
            models = [KMeans(k=k, seed=s, maxIter=20).fit(rows) for s in seeds]
            model = min(models, key=lambda m: m.summary.trainingCost)
            score = ClusteringEvaluator().evaluate(model.transform(rows))
            if best is None or score > best[0]:
                best = score, model, k
        return best and (best[1], best[2])
    finally:
        rows.unpersist()


def assign(df: DataFrame, vector: str, model: KMeansModel) -> DataFrame:
    """cluster_id and dist_to_centroid for every row."""
    centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    far = lambda c: F.sqrt(F.aggregate(F.zip_with(F.col(vector), c, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda a, x: a + x))
    near = F.array_min(F.transform(centers, lambda c, i: F.struct(far(c).alias("d"), i.alias("i"))))
    return df.withColumn("__near", near).withColumns({"cluster_id": F.col("__near.i"), "dist_to_centroid": F.round("__near.d", 4)}).drop("__near")


def silhouette_samples(df: DataFrame, vector: str, cluster: str = "cluster_id") -> DataFrame:
    """``df`` with ``silhouette_sample``: how much nearer a row is, by mean squared distance, to its own
    cluster than to the next one (-1 to 1; 0 for a lone row or a lone cluster), to 4 places.

    The mean squared distance to a cluster follows from the cluster's count, sum vector and sum of
    squared norms, so that no two rows are paired.
    """
    norm = lambda v: dot(v, v)
    sizes = df.groupBy(cluster).agg(F.count("*").alias("n"), F.sum(norm(F.col(vector))).alias("norms"))
    at = df.select(cluster, F.posexplode(vector).alias("at", "v")).groupBy(cluster, "at").agg(F.sum(F.col("v").cast("double")).alias("v"))
    sums = at.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("sums"))
    table = sizes.join(sums, cluster).agg(F.collect_list(F.struct(F.col(cluster).alias("id"), "n", "norms", "sums")).alias("__clusters"))
    own = lambda c: c["id"] == F.col(cluster)
    # a row is no neighbour of itself
    far = lambda c: (norm(F.col(vector)) * c["n"] + c["norms"] - 2 * dot(F.col(vector), c["sums"])) / F.when(own(c), F.greatest(c["n"] - 1, F.lit(1))).otherwise(c["n"])
    rows = df.crossJoin(F.broadcast(table)).withColumn("__far", F.transform("__clusters", lambda c: F.struct(own(c).alias("own"), c["n"].alias("n"), far(c).alias("d"))))  # one row
    mine = F.get(F.filter("__far", lambda x: x["own"]), F.lit(0))
    a, b = mine["d"], F.array_min(F.transform(F.filter("__far", lambda x: ~x["own"]), lambda x: x["d"]))
    s = F.when((mine["n"] > 1) & b.isNotNull() & (F.greatest(a, b) > 0), (b - a) / F.greatest(a, b)).otherwise(0.0)
    return rows.withColumn("silhouette_sample", F.round(s, 4)).drop("__far", "__clusters")


def cluster_scopes(df: DataFrame, key: str, vector: str, scopes: dict[str, tuple[Column, tuple[int, ...]]], seeds: tuple[int, ...] = STARTS, run_id: str = "") -> DataFrame:
    """Each scope's rows (a condition and the k to try) clustered on their own: key, run_id, algo, k,
    scope, cluster_id, dist_to_centroid, silhouette_sample.  A scope too small for its k gives no row."""
    out = None
    for name, (where, ks) in scopes.items():
        part = df.where(where).select(key, vector)
        found = cluster(part, vector, ks, seeds)
        if found is None:
            continue
        rows = silhouette_samples(assign(part, vector, found[0]), vector)
        rows = rows.select(key, F.lit(run_id).alias("run_id"), F.lit("kmeans").alias("algo"), F.lit(found[1]).alias("k"), F.lit(name).alias("scope"), "cluster_id", "dist_to_centroid", "silhouette_sample")
        out = rows if out is None else out.unionByName(rows)
    schema = f"{key} {dict(df.dtypes)[key]}, run_id string, algo string, k int, scope string, cluster_id int, dist_to_centroid double, silhouette_sample double"
    return df.sparkSession.createDataFrame([], schema) if out is None else out
