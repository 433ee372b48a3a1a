"""What a corpus holds: overview, frequent terms, cluster tables and evidence for branches of a taxonomy.

Every table is a lazy DataFrame of few rows; ``report`` alone collects them, as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.functions import text as T
from talus.operators import aggregates as A

# Words that are no title terms, and letters that titles are made of.
STOP = [
    "the", "and", "for", "of", "in", "a", "to", "with", "senior", "junior", "and/or", "intern", "lead", "manager", "chuyên", "viên", "nhân", "kỹ", "sư", "và", "các",
    "cao", "cấp", "cum", "mid", "staff", "principal", "remote", "hybrid",
]
LETTERS = "[a-zA-Zàáạảãâầấậẩẫăằắặẳẵèéẹẻẽêềếệểễìíịỉĩòóọỏõôồốộổỗơờớợởỡùúụủũưừứựửữỳýỵỷỹđ]+"


def title_terms(titles: Column) -> Column:
    """Words and word pairs of a title without stop words."""
    return A.terms(T.tokens(titles, STOP, LETTERS))


def top_items(df: DataFrame, by: list[str], items: Column, n: int) -> DataFrame:
    """A row for each group: its ``n`` most frequent items as ``item (count)``, joined; ties by name."""
    counted = df.select(*by, F.explode(items).alias("item")).groupBy(*by, "item").agg(F.count("*").alias("n"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), "item"))), 1, n)
    joined = F.array_join(F.transform(best, lambda x: F.format_string("%s (%d)", x["item"], -x["rank"])), ", ")
    return counted.groupBy(*by).agg(joined.alias("top"))


def cluster_table(rows: DataFrame, terms: int = 6) -> DataFrame:
    """A row for each scope and cluster: size, top title terms and skills, the most frequent source,
    language and role, and the mean silhouette."""
    by = ["scope", "cluster_id"]
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg("silhouette_sample"), 3).alias("silhouette"))
    for name, items in (("titles", title_terms(F.col("title"))), ("skills", F.col("skills"))):
        out = out.join(top_items(rows, by, items, terms).withColumnRenamed("top", f"top_{name}"), by, "left")
    for name in ("source", "lang", "role_category"):
        out = out.join(A.mode_by(rows, by, name).withColumnRenamed(name, f"top_{name}"), by, "left")
    return out


def discovery(texts: DataFrame, clusters: DataFrame, roles: list[str], branches: dict[str, str]) -> dict[str, DataFrame]:
    """The tables of a discovery report.

    ``texts``: job_id, title, skills, source, lang, role_category, is_active; ``clusters``: rows of
    ``vectors.cluster_scopes`` (a row without a text keeps its place, with nulls).  ``branches`` names title patterns of
    which it is asked how many texts match and how many of those have no role.
    """
    rows = clusters.join(texts, "job_id", "left")
    found = F.array(*[F.struct(F.lit(k).alias("branch"), F.coalesce(F.col("title").rlike(p), F.lit(False)).alias("hit")) for k, p in branches.items()])
    each = texts.select("role_category", F.explode(found).alias("b")).where("b.hit")
    return {
        "overview": A.overview(texts, "is_active", "source", "lang", "role_category"),
        "title_terms": top_items(texts, [], title_terms(F.col("title")), 25),
        "skills": top_items(texts, [], F.col("skills"), 25),
        "clusters": cluster_table(rows),
        "roles_by_cluster": A.crosstab(rows.where("scope = 'all'"), "cluster_id", "role_category", roles),
        "branches": each.groupBy("b.branch").agg(F.count("*").alias("n"), F.count_if(F.col("role_category") == "OTHER").alias("n_other")),
    }


def report(title: str, tables: dict[str, DataFrame], order: dict[str, list[str]] | None = None) -> str:
    """The tables as text: a heading and a pipe table each, rows by their first columns or by ``order``."""
    out = [f"# {title}"]
    for name, df in tables.items():
        rows = df.orderBy(*(order or {}).get(name, df.columns[:2])).collect()
        show = lambda v: "—" if v is None else str(v)
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "--|" * len(df.columns)]
        out += ["| " + " | ".join(show(v) for v in r) + " |" for r in rows]
    return "\n".join(out)


def taxonomy(functions: list[dict], domains: list[str], evidence: dict[str, DataFrame], **notes) -> dict:
    """A faceted taxonomy (function, domain, data intensity) for the YAML sink: the functions as
    they are given, every domain once, and the rows of one-row evidence tables as what it rests on."""
    missing = [f for f in functions if not {"code", "name", "definition", "inclusion", "exclusion"} <= set(f)]
    if missing or len({f["code"] for f in functions}) < len(functions):
        raise ValueError(f"functions need distinct codes and all fields: {[f.get('code') for f in missing]}")
    intensity = {"type": "float 0..1 (independent facet)", "guide": {"0.0-0.3": "minimal data work", "0.3-0.6": "mixed/analytics-adjacent", "0.6-1.0": "core data role"}}
    said = {k: df.first().asDict() for k, df in evidence.items()}
    return {"version": 1, "scheme": "faceted: function × domain × data_intensity", **notes, "validation_from_discovery": said, "functions": functions, "domains": list(dict.fromkeys(domains)), "data_intensity": intensity}
