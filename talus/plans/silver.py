"""From raw postings to normalised rows and published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talus.functions import rules as R
from talus.functions import text as T
from talus.operators import aggregates as A
from talus.operators.dedup import fuzzy


def normalise(jobs: DataFrame, aliases: dict[str, str], roles: list, company_types: list) -> DataFrame:
    """One projection from raw to normalised columns; only the regular expressions do work."""
    field = lambda k: F.get_json_object("extra", f"$.{k}")
    filled = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])
    position, model = filled(field("position_label"), field("role_category_hint")), filled(field("work_model"), field("work_model_raw"))
    fold = lambda c: T.strip_accents(T.norm(c))
    place = fold(F.col("location_raw"))
    skills, unmapped = T.extract_terms(F.col("skills_raw"), F.col("description_raw"), aliases)
    head = T.strip_accents(T.norm(F.concat_ws(" ", "company_raw", F.substring("description_raw", 1, 300))))
    rows = jobs.withColumns({
        "job_id": F.concat_ws(":", "source", "source_job_id"), "title_clean": T.clean_title(F.col("title_raw")), "company": F.trim("company_raw"),
        "company_key": T.clean_company(F.col("company_raw"), R.LEGAL), "skills": skills, "unmapped": unmapped, "__place": T.first_place(place, R.CITIES),
        "seniority": T.first_rule(T.norm(F.concat_ws(" ", "title_raw", field("seniority_label"))), R.SENIORITY, "Mid"),
        "role_category": T.first_rule(T.norm(F.concat_ws(" ", "title_raw", position, F.concat_ws(" ", skills))), roles, "OTHER"),
        "remote_flag": T.any_of(T.strip_accents(T.norm(model)), ["remote", "hybrid"]) | T.any_of(place, R.REMOTE),
        "language_req": T.codes_of(T.strip_accents(T.norm(F.concat_ws(" ", "description_raw", field("language_req_raw")))), R.LANGUAGES),
        "company_type": T.first_rule(head, [(k, [T_plain(p) for p in ps]) for k, ps in company_types], "other"),
    })
    rows = rows.withColumns({"city": F.col("__place.place"), "region": F.col("__place.region"), "n_skills": F.size("skills"), "__folded": fold(F.col("title_clean"))}).drop("__place")
    return fuzzy(rows, "job_id", "company_key", "city", "__folded", ["effective_date", "job_id"]).drop("__folded")


def T_plain(pattern: str) -> str:
    """A pattern without accents, as the expressions see their text."""
    return pattern.translate(str.maketrans(*T.accents()))


def gold(silver: DataFrame, observations: DataFrame) -> dict[str, DataFrame]:
    """The published tables over active, unique rows of a known role; lazily, from one scan each."""
    base = silver.where((F.col("role_category") != "OTHER") & F.col("is_active") & F.col("is_duplicate_of").isNull())
    by_skill = A.items(base.select("job_id", "role_category", "seniority", "skills"), "skills", "skill")
    return {
        "skill_demand": A.share(by_skill, "job_id", ["skill"], whole=base),
        "role_skill_matrix": A.share(by_skill, "job_id", ["role_category", "skill"], ["role_category"], base),
        "seniority_progression": A.share(by_skill, "job_id", ["seniority", "skill"], ["seniority"], base),
        "role_by_location": A.cross(base, "job_id", ["role_category", "region", "city"]),
        "company_type_demand": A.cross(base, "job_id", ["company_type", "role_category"]),
        "skill_cooccurrence": A.pairs(by_skill, "job_id", "skill"),
        "trend": A.trend(observations.join(by_skill.select("job_id", "skill"), "job_id"), "job_id", "snapshot_date", "skill"),
    }


def family_gold(silver: DataFrame) -> dict[str, DataFrame]:
    """The published tables by labelled family; shares count rows of a null domain in the whole."""
    jobs = silver.where(F.col("job_family").isNotNull() & F.col("is_active") & F.col("is_duplicate_of").isNull())
    base = jobs.where(F.col("job_family") != "OTHER")
    by_skill = A.items(base.select("job_id", "job_family", "skills"), "skills", "skill")
    return {
        "gold_jobs": jobs.drop("unmapped"),
        "gold_market_share": A.share(base, "job_id", ["domain", "job_family"]),
        "gold_family_skill": A.share(by_skill, "job_id", ["job_family", "skill"], ["job_family"], base),
        "gold_company": A.cross(base, "job_id", ["company_type", "job_family"]),
        "gold_location": A.cross(base, "job_id", ["job_family", "region", "city"]),
        "gold_seniority": A.cross(base, "job_id", ["job_family", "seniority"]),
        "gold_skill_cooccurrence": A.pairs(by_skill, "job_id", "skill"),
    }
