"""Postings of cached board responses of five kinds, by field rules: REST, search, graph and two of HTML cards.

Each reader takes raw pages (item, page, payload) and gives a row for each posting, in page order:
item, page, pos and the posting columns of ``postings.POSTING``.  A page that is no JSON of the kind
gives none; absent and blank fields are null, absent lists empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talus.functions.text import html_text
from talus.sources.postings import hex_id, in_domain, work_model

# What a posting of the domain is called, and the note on what is not read.
DATA_ROLE = r"(?i)\b(data\s*(analyst|engineer|scientist|analytics|architect|warehouse)|machine\s*learning|ml\s*engineer|mlops|business\s*intelligence|analytics\s*engineer|big\s*data|data\s*science|ai\s*engineer)\b"
SALARY = "ignored_out_of_scope"

_NAMED = "struct<name:string>"
_DATED = "struct<date:string>"
REST = (
    "id string, title string, content string, requirements string, company struct<display_name:string>, addresses struct<address_region_array:array<string>>, skills_arr array<string>, "
    f"published {_DATED}, created {_DATED}, refreshed {_DATED}, detail_url string, slug string, job_levels string"
)
SEARCH = (
    "jobId string, jobTitle string, companyName string, skills array<struct<skillName:string>>, workingLocations array<struct<cityNameVI:string,cityName:string>>, jobDescription string, jobRequirement string, address string, "
    "createdOn string, jobUrl string, alias string, jobLevelVI string, jobLevel string, languageSelectedVI string, typeWorkingVI string, yearsOfExperience string, jobFunctionsV3 array<struct<nameVI:string,name:string>>"
)
GRAPH = (
    f"id string, title string, company struct<name:string,brandName:string>, location {_NAMED}, citySubDivision {_NAMED}, city {_NAMED}, skills array<struct<skill:{_NAMED}>>, hierarchicalJobCategory {_NAMED}, "
    "createdAt string, workArrangementOption string, educationLevel string, minYearsOfExperience string, maxYearsOfExperience string"
)


def clean(c: Column) -> Column:
    """White space collapsed; blank is null."""
    return F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def plain(html: Column) -> Column:
    """The text of a field that holds markup, or a JSON list of such strings."""
    listed = F.concat_ws(" ", F.from_json(html, "array<string>"))
    return F.nullif(html_text(F.when(F.startswith(F.trim(html), F.lit("[")), F.coalesce(F.nullif(listed, F.lit("")), html)).otherwise(html)), F.lit(""))


def _filled(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _list(values: Column) -> Column:
    """A list without nulls and blanks; an absent one is empty."""
    return F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))


def _joined(values: Column, sep: str) -> Column:
    return F.nullif(F.concat_ws(sep, values), F.lit(""))


def _rows(pages: DataFrame, path: str, fields: str) -> DataFrame:
    """A row (item, page, pos, j) for each element of the payload's list at ``path``."""
    kind = f"array<struct<{fields}>>".replace(", ", ",")
    for name in reversed(path.split(".")):
        kind = f"struct<{name}:{kind}>"
    found = F.from_json("payload", _colons(kind))
    for name in path.split("."):
        found = found[name]
    return pages.select("item", "page", F.posexplode(found).alias("pos", "j"))


def _colons(kind: str) -> str:
    """``name type`` as a struct type writes it, ``name:type``."""
    return ",".join(x.replace(" ", ":", 1) if " " in x else x for x in kind.split(","))


def _posting(rows: DataFrame, source: str, extra: dict[str, Column], **columns: Column) -> DataFrame:
    names = ("source_job_id", "url", "title_raw", "company_raw", "location_raw", "skills_raw", "description_raw", "posted_date_raw")
    kept = [columns.get(c, F.lit(None).cast("string")).alias(c) for c in names]
    noted = F.to_json(F.struct(*[c.alias(k) for k, c in extra.items()], F.lit(SALARY).alias("salary_status")))
    return rows.select("item", "page", "pos", F.lit(source).alias("source"), *kept, F.current_timestamp().alias("ingested_at"), noted.alias("extra"))


def rest(pages: DataFrame, source: str) -> DataFrame:
    """``data`` of a REST answer; of its dates the published one, else the created, else the refreshed."""
    j = F.col("j")
    regions = _list(j["addresses"]["address_region_array"])
    return _posting(
        _rows(pages, "data", REST), source, {"query_seen_in": F.col("item"), "slug": j["slug"], "regions": regions, "seniority_label": j["job_levels"]},
        source_job_id=j["id"], url=clean(j["detail_url"]), title_raw=clean(j["title"]), company_raw=clean(j["company"]["display_name"]), location_raw=_joined(regions, ", "), skills_raw=_list(j["skills_arr"]),
        description_raw=_joined(F.array(plain(j["content"]), plain(j["requirements"])), " \n"), posted_date_raw=_filled(j["published"]["date"], j["created"]["date"], j["refreshed"]["date"]),
    )


def search(pages: DataFrame, source: str, base: str) -> DataFrame:
    """``data`` of a POST search; several cities are joined, and an alias stands in for a missing URL."""
    j = F.col("j")
    cities = _list(F.transform(j["workingLocations"], lambda x: _filled(x["cityNameVI"], x["cityName"])))
    extra = {
        "query_seen_in": F.col("item"), "cities": cities, "seniority_label": _filled(j["jobLevelVI"], j["jobLevel"]), "language_req_raw": j["languageSelectedVI"], "work_model_raw": j["typeWorkingVI"],
        "years_of_experience": j["yearsOfExperience"], "job_functions": _list(F.transform(j["jobFunctionsV3"], lambda x: _filled(x["nameVI"], x["name"]))),
    }
    return _posting(
        _rows(pages, "data", SEARCH), source, extra,
        source_job_id=j["jobId"], url=F.coalesce(clean(j["jobUrl"]), F.concat(F.lit(base + "/"), F.nullif(j["alias"], F.lit("")), F.lit("-jv"))), title_raw=clean(j["jobTitle"]), company_raw=clean(j["companyName"]),
        location_raw=F.coalesce(_joined(cities, ", "), clean(j["address"])), skills_raw=_list(F.transform(j["skills"], lambda x: x["skillName"])),
        description_raw=_joined(F.array(plain(j["jobDescription"]), plain(j["jobRequirement"])), " \n"), posted_date_raw=j["createdOn"],
    )


def graph(pages: DataFrame, source: str, base: str, size: int, domain: str = DATA_ROLE) -> DataFrame:
    """``data.searchJobs.jobsInPage`` of a graph query, whole pages first: an item ends after its first
    page of fewer than ``size`` raw postings; only then go those whose category and title are off the domain."""
    j = F.col("j")
    category = j["hierarchicalJobCategory"]["name"]
    rows = _rows(pages, "data.searchJobs.jobsInPage", GRAPH)
    short = rows.groupBy("item", "page").agg(F.count("*").alias("n")).where(F.col("n") < size).groupBy("item").agg(F.min("page").alias("__last"))
    rows = rows.join(short, "item", "left").where(F.col("__last").isNull() | (F.col("page") <= F.col("__last")))
    rows = rows.withColumns({"__category": category, "__title": j["title"]}).where(in_domain(domain, "__category", "__title"))
    extra = {
        "query_seen_in": F.col("item"), "role_category_hint": category, "work_model_raw": j["workArrangementOption"], "education_level": j["educationLevel"],
        "min_years_exp": j["minYearsOfExperience"], "max_years_exp": j["maxYearsOfExperience"],
    }
    return _posting(
        rows, source, extra,
        source_job_id=j["id"], url=F.concat(F.lit(base + "/"), j["id"]), title_raw=j["title"], company_raw=_filled(j["company"]["name"], j["company"]["brandName"]),
        location_raw=_filled(j["location"]["name"], j["citySubDivision"]["name"], j["city"]["name"]), skills_raw=_list(F.transform(j["skills"], lambda x: x["skill"]["name"])), posted_date_raw=j["createdAt"],
    )


def _pieces(pages: DataFrame, starts: list[str]) -> DataFrame:
    """A row (item, page, pos, card) for each card: the page from one opening tag of a card to the next.
    Of the patterns of opening tags the first that the page has counts."""
    found = F.coalesce(*[F.when(F.rlike("payload", F.lit(p)), F.slice(F.split(F.regexp_replace("payload", p, "\x00$0"), "\x00"), F.lit(2), F.length("payload"))) for p in starts])
    return pages.select("item", "page", F.posexplode(found).alias("pos", "card"))


def _opening(tag: str, attr: str, word: str = "") -> str:
    value = rf"""=["'][^"']*(?<![\w-]){word}(?![\w-])[^"']*["']""" if word else r"""=["'][^"']+["']"""
    return rf"(?is)<{tag}\b[^>]*\s{attr}{value}[^>]*>"


def _inner(card: Column, tag: str, word: str) -> Column:
    """The text of the card's first such element (up to its own end tag's name)."""
    return clean(html_text(F.regexp_extract(card, _opening(tag, "class", word) + rf"(.*?)</{tag}\s*>", 1)))


def _first(card: Column, *places: tuple[str, str]) -> Column:
    return F.coalesce(*[_inner(card, tag, word) for tag, word in places])


def _attr(card: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(card, rf"""(?is)\s{name}=["']([^"']+)["']""", 1), F.lit(""))


def _all(card: Column, *places: tuple[str, str]) -> Column:
    each = [F.transform(F.regexp_extract_all(card, F.lit(_opening(tag, "class", word) + rf"(.*?)</{tag}\s*>"), F.lit(1)), lambda x: clean(html_text(x))) for tag, word in places]
    return F.array_distinct(_list(F.concat(*each)))


def listing(pages: DataFrame, source: str, words: tuple[str, ...] = ("job-card", "job")) -> DataFrame:
    """Cards whose location begins with the work model; dates are relative."""
    rows = _pieces(pages, [_opening("div", "class", w) for w in words])
    card = F.col("card")
    link = _attr(F.regexp_extract(card, r"(?is)<a\b[^>]*>", 0), "href")
    model, place = work_model(_first(card, ("div", "location"), ("span", "location"), ("div", "city"), ("span", "city")))
    return _posting(
        rows, source, {"category_seen_in": F.col("item"), "work_model": model},
        source_job_id=F.coalesce(_attr(card, "data-job-key"), _attr(card, "data-job-id"), hex_id(link)), url=link, title_raw=clean(html_text(F.regexp_extract(card, r"(?is)<h3\b[^>]*>(.*?)</h3\s*>", 1))),
        company_raw=_first(card, ("a", "company"), ("div", "company"), ("span", "company")), location_raw=clean(place), skills_raw=_all(card, ("a", "tag"), ("a", "itag")), posted_date_raw=_first(card, ("span", "small-text"), ("div", "date"), ("span", "date")),
    ).where("source_job_id is not null")


def cards(pages: DataFrame, source: str) -> DataFrame:
    """Cards of a page whose markup changes: of several selectors the first that finds anything counts."""
    rows = _pieces(pages, [_opening("div", "class", "job-item-search-result"), _opening("div", "class", "job-item-2"), _opening("div", "data-job-id"), _opening("div", "class", "job-item")])
    card = F.col("card")
    anchor = F.regexp_extract(card, r"""(?is)<(?:h3|[a-z]+[^>]*class=["'][^"']*\btitle\b[^"']*["'])[^>]*>\s*(<a\b.*?</a\s*>)""", 1)
    return _posting(
        rows, source, {"category_seen_in": F.col("item")},
        source_job_id=F.coalesce(_attr(card, "data-job-id"), _attr(card, "data-job")), url=_attr(anchor, "href"), title_raw=clean(html_text(anchor)),
        company_raw=_first(card, ("a", "company"), ("span", "company-name"), ("div", "company-name"), ("a", "company-name")), location_raw=_first(card, *[(t, w) for w in ("address", "city", "location", "job-location") for t in ("label", "span", "div")]),
        skills_raw=_all(card, *[(t, w) for w in ("tag", "skill") for t in ("a", "span", "div")]), posted_date_raw=_first(card, *[(t, w) for w in ("time", "deadline", "job-deadline", "label-update") for t in ("label", "span", "div")]),
    ).where("source_job_id is not null")


def first_seen(rows: DataFrame) -> DataFrame:
    """Of each posting id the first row in order of item, page and place."""
    at = Window.partitionBy("source", "source_job_id").orderBy("item", "page", "pos")
    return rows.withColumn("__rn", F.row_number().over(at)).where("__rn = 1").drop("__rn")


def run_stats(rows: DataFrame) -> DataFrame:
    """A row for each source: distinct postings, pages, share of those with a description, and its most
    frequent locations (five, by count, then name)."""
    once = first_seen(rows)
    place = once.where("location_raw is not null").groupBy("source", "location_raw").agg(F.count("*").alias("n"))
    ranked = place.withColumn("rn", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "location_raw"))).where("rn <= 5")
    top = ranked.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "location_raw"))), lambda x: x["location_raw"]), "; ").alias("top_locations"))
    pages = rows.groupBy("source").agg(F.count_distinct("item", "page").alias("pages"))
    sums = once.groupBy("source").agg(F.count("*").alias("postings"), F.round(100 * F.avg(F.col("description_raw").isNotNull().cast("int")), 1).alias("described"))
    return sums.join(pages, "source").join(top, "source", "left")
