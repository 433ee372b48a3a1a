import random
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from talus.functions import dates, rules
from talus.functions import text as T
from talus.operators import aggregates, cascade, cdc, dedup, dispatch, vectors
from talus.plans import discovery, silver
from talus.sources import postings


def value(spark, column, schema=None, row=None):
    df = spark.range(1) if row is None else spark.createDataFrame([row], schema)
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("2026-05-28T15:10:39+07:00", date(2026, 5, 28)),
        ("2026-06-05T07:32:34.028Z", date(2026, 6, 5)),
        ("2026-06-15", date(2026, 6, 15)),
        ("20260615", date(2026, 6, 15)),
        ("12-06-2026", date(2026, 6, 12)),
        ("Hạn nộp: 30-09-2026 Cập nhật: 09-06-2026", date(2026, 6, 9)),
        ("2 days ago", date(2026, 6, 14)),
        ("3 hours ago", date(2026, 6, 16)),
        ("soon", None),
        ("2026-06-05Tgarbage", None),
        (None, None),
    ],
)
def test_posted_date(spark, raw, want):
    assert value(spark, dates.posted_date(F.lit(raw).cast("string"), F.lit("2026-06-16").cast("date"))) == want


def test_rules(spark):
    rank = lambda t: value(spark, T.first_rule(T.norm(F.lit(t)), rules.SENIORITY, "Mid"))
    assert [rank(t) for t in ("Data Intern", "International Analyst", "Sr. Analyst", "Head of Data", "")] == ["Intern", "Mid", "Senior", "Manager", "Mid"]
    place = value(spark, T.first_place(T.strip_accents(T.norm(F.lit("Quận 1, Hồ Chí Minh; Hà Nội"))), rules.CITIES))
    assert tuple(place) == ("Hồ Chí Minh", "South")
    assert value(spark, T.first_place(T.strip_accents(T.norm(F.lit("Đà Nẵng"))), rules.CITIES)["place"]) is None
    assert value(spark, T.strip_accents(F.lit("Đà Nẵng đ"), True)) == "Da Nang d"
    assert value(spark, T.clean_company(F.lit("Công ty TNHH Talus Việt Nam"), rules.LEGAL)) == "talus"
    assert value(spark, T.clean_company(F.lit(" "), rules.LEGAL)) is None
    assert value(spark, T.clean_title(F.lit("[HCM] Analyst (Remote)"))) == "Analyst"
    assert not value(spark, T.contains_word(F.lit("đai"), "ai"))
    assert value(spark, T.codes_of(T.strip_accents(T.norm(F.lit("Tiếng Anh"))), rules.LANGUAGES)) == ["EN"]


def test_terms(spark):
    aliases = {"python": "Python", "py": "Python", "sql": "SQL", "power bi": "Power BI", "r": "R"}
    found, unmapped = T.extract_terms(F.array(F.lit("PY"), F.lit("cobol"), F.lit("")), F.lit("r, Power  BI and mysql"), aliases)
    assert value(spark, found) == ["Power BI", "Python"]
    assert value(spark, unmapped) == ["cobol"]


def test_token_set_ratio():
    assert dedup.token_set_ratio("data analyst", "analyst data senior") == 100.0
    assert dedup.token_set_ratio("", "x") == 0.0
    assert dedup.token_set_ratio("abc", "abd") == pytest.approx(200 * 2 / 6)


def test_fuzzy_is_greedy_and_blocked(spark):
    rows = [("1", "k", None, "data analyst"), ("2", "k", None, "Data analyst"[0:].lower()), ("3", "k", "x", "data analyst"), ("4", "", None, "data analyst"), ("5", "k", None, "welder")]
    df = spark.createDataFrame(rows, "id string, block string, city string, title string")
    out = {r["id"]: r["is_duplicate_of"] for r in dedup.fuzzy(df, "id", "block", "city", "title", ["id"]).collect()}
    assert out == {"1": None, "2": "1", "3": None, "4": None, "5": None}


def test_fuzzy_against_row_by_row(spark):
    r = random.Random(5)
    words = ["data", "analyst", "senior", "lead", "engineer", "bi"]
    titles = ["", " ", "\t", None] + [" ".join(r.sample(words, r.randint(1, 4))) for _ in range(60)]
    rows = [(f"{i:03d}", r.choice(["k", "m", None]), r.choice(["x", None]), r.choice(titles)) for i in range(200)]
    kept, want = [], {}
    for i, block, city, title in rows:
        hit = next((k for k, b, c, t in kept if (b, c) == (block, city) and dedup.token_set_ratio(title or "", t) >= 90), None) if block else None
        want[i] = hit
        if block and hit is None:
            kept.append((i, block, city, title or ""))
    df = spark.createDataFrame(rows, "id string, block string, city string, title string")
    assert {x["id"]: x["is_duplicate_of"] for x in dedup.fuzzy(df, "id", "block", "city", "title", ["id"]).collect()} == want


def test_change_tracking_by_step_equals_replay(spark):
    r = random.Random(3)
    master = spark.createDataFrame([], "source string, id string, title string, posted_date date, first_seen_date date, last_seen_date date, is_active boolean, removed_date date, miss_streak int, last_streak_run date")
    log = spark.createDataFrame([], "source string, id string, snapshot_date date")
    schema = "source string, id string, title string, posted_date date"
    for day in ("2026-01-01", "2026-01-02", "2026-01-02", "2026-01-03", "2026-01-04"):
        for source, full in (("full", True), ("part", False)):
            batch = spark.createDataFrame([(source, x, day, None) for x in "abc" if r.random() < 0.6] or [(source, "z", day, None)], schema)
            master = cdc.step(master, batch, ["source", "id"], ["title"], day, "source", full)
            log = cdc.observe(log, batch, ["source", "id"], day)
            master, log = (spark.createDataFrame(x.collect(), x.schema) for x in (master, log))
    state = {(x["source"], x["id"]): (x["first_seen_date"], x["last_seen_date"], x["is_active"], x["removed_date"]) for x in master.collect()}
    again = cdc.replay(log, ["source", "id"], "source", F.col("source") == "full").collect()
    assert state == {(x["source"], x["id"]): (x["first_seen"], x["last_seen"], x["is_active"], x["removed"]) for x in again}


def test_silver_and_gold(spark):
    job = ("s", "1", "Data Engineer (HN)", "Công ty A", "Hà Nội", ["sql"], "python english", None, "{}", "2026-01-01", True)
    schema = "source string, source_job_id string, title_raw string, company_raw string, location_raw string, skills_raw array<string>, description_raw string, posted_date_raw string, extra string, effective_date string, is_active boolean"
    rows = spark.createDataFrame([job, ("t", "2", *job[2:])], schema)
    out = silver.normalise(rows, {"sql": "SQL", "python": "Python"}, [("DE", ["data engineer"])], [("bank", ["ngân hàng"])])
    got = {r["job_id"]: r for r in out.collect()}
    assert got["t:2"]["is_duplicate_of"] == "s:1" and got["s:1"]["skills"] == ["Python", "SQL"] and got["s:1"]["role_category"] == "DE"
    seen = spark.createDataFrame([("s:1", "2026-01-01")], "job_id string, snapshot_date string")
    tables = silver.gold(out, seen)
    assert {r["skill"]: (r["n"], r["pct"]) for r in tables["skill_demand"].collect()} == {"SQL": (1, 100.0), "Python": (1, 100.0)}
    assert tables["skill_cooccurrence"].count() == 1 and tables["trend"].count() == 2


def test_readers(spark):
    page = '<div class="job"><h3>Analyst</h3></div><div class="job"><h3>Welder &amp; Co</h3></div>'
    rows = spark.createDataFrame([("q", 1, page)], "item string, page int, payload string")
    assert [r["title"] for r in postings.cards(rows, '<div class="job">.*?</div>', {"title": "<h3>(.*?)</h3>"}).collect()] == ["Analyst", "Welder & Co"]
    ld = '<script type="application/ld+json">{"@type":"JobPosting","description":"<p>x</p>","skills":"a, b,"}</script>'
    assert value(spark, postings.posting_ld(F.lit(ld))).skills == ["a", "b"]
    assert value(spark, postings.rich_text(F.lit('{"c":[{"text":"a\\"b"},{"text":" "},{"text":"c"}]}'))) == 'a"b\nc'
    assert value(spark, postings.total(F.lit("1,234 jobs"))) == 1234
    listed = spark.createDataFrame([("a", 1, 0, "x"), ("a", 1, 1, "y"), ("a", 2, 0, "z"), ("a", 3, 0, "w"), ("b", 1, 0, "x")], "item string, page int, pos int, source_job_id string")
    first, new = postings.paginate(listed, 2)
    assert sorted(r["source_job_id"] for r in first.collect()) == ["x", "y", "z"]
    assert {r["item"]: r["new_ids"] for r in new.collect()} == {"a": 3}


class Clock:
    now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.now += s


def test_dispatch():
    def limited(job):
        raise dispatch.RateLimited("429 per day")

    clock, jobs = Clock(), [{"job_id": str(i), "content_hash": str(i % 2)} for i in range(4)]
    good = dispatch.Provider("good", lambda j: {"job_family": "X"}, 1.0)
    out = dispatch.dispatch(jobs, [dispatch.Provider("bad", limited), good], clock=clock, sleep=clock.sleep)
    assert sorted(x["job_id"] for x in out) == ["0", "1", "2", "3"] and {x["method"] for x in out} == {"llm:good"} and good.used == 2
    out = dispatch.dispatch(jobs, [dispatch.Provider("bad", limited)], clock=clock, sleep=clock.sleep)
    assert {x["method"] for x in out} == {"manual_review"}
    capped = dispatch.Provider("capped", lambda j: {"job_family": "X"}, cap=1)
    out = dispatch.dispatch([{"job_id": str(i)} for i in range(3)], [capped], clock=clock, sleep=clock.sleep)
    assert sorted(x["method"] for x in out) == ["llm:capped", "manual_review", "manual_review"] and capped.used == 1
    assert [dispatch.parse_duration(x) for x in ("250ms", "1m2s", "7", "soon", None)] == [0.25, 62.0, 7.0, 5.0, 5.0]


@pytest.mark.parametrize(
    ("source", "raw", "want"),
    [
        ("vietnamworks", "2026-05-28T15:10:39+07:00", date(2026, 5, 28)),
        ("glints", "2 days ago", None),
        ("itviec", "Posted 2 days ago", date(2026, 6, 14)),
        ("itviec", "2026-06-15", None),
        ("topdev", "12-06-2026", date(2026, 6, 12)),
        ("topdev", "31-02-2026", None),
        ("careerviet", "Hạn nộp: 30-09-2026 Cập nhật: 09-06-2026", date(2026, 6, 9)),
        ("careerviet", "09-06-2026", None),
        ("other", " 2026-06-15 ", date(2026, 6, 15)),
        ("itviec", None, None),
    ],
)
def test_posted_date_by_source(spark, source, raw, want):
    assert value(spark, dates.posted_date(F.lit(raw).cast("string"), F.lit("2026-06-16").cast("date"), F.lit(source))) == want


def test_normalisers(spark):
    _, unmapped = T.extract_terms(F.array(F.lit(" CoBOL "), F.lit("SQL"), F.lit(" ")), F.lit(None).cast("string"), {"sql": "SQL"})
    assert value(spark, unmapped) == [" CoBOL "]
    assert value(spark, T.clean_title(F.lit(" \t "))) is None and value(spark, T.clean_title(F.lit("(x)"))) == "(x)"
    assert value(spark, T.first_rule(T.norm(F.lit("power bi")), [("BI", ["Power  BI", ""])], "-")) == "BI"
    assert value(spark, T.letter_ratio(F.lit("ạb đc"), "đ", marked=True)) == 0.5


def test_label_records(spark):
    rows = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y"), ("3", "c", "z")], "job_id string, content_hash string, text string")
    open_ = cascade.tiers(rows, F.when(F.col("text") == "x", "R"), F.lit("V"), F.lit(0.1), F.lit(0.1))
    cache = spark.createDataFrame([("b", "K2", 0.9, "r", "two"), ("b", "K1", 0.5, "why", "one"), ("c", None, 0.9, "torn", "one")], "content_hash string, code string, confidence double, reasoning string, judge string")
    names = spark.createDataFrame([("R", "D", "S")], "code string, domain string, subdomain string")
    got = {r["job_id"]: r for r in cascade.label(open_, "content_hash", "text", "job_id", lambda t: (None, 0.0, ""), "stub", names, cache).collect()}
    assert len(got) == 3 and [(got[k]["job_family"], got[k]["review_status"], got[k]["labeling_method"]) for k in "123"] == [("R", "resolved", "rule"), ("K1", "manual_review", "llm:one"), ("OTHER", "manual_review", "failed")]
    assert got["3"]["reasoning"] == "stub failed" and got["1"]["reasoning"] == "title alias 'R'"
    assert cascade.first_answers(cache, "content_hash", ["two"]).first()["code"] == "K2"


def test_silhouettes_and_scopes(spark):
    r = random.Random(1)
    pts = [(i, [r.gauss(5 * (i % 3), 0.5), r.gauss(0, 0.5)], i % 3) for i in range(45)] + [(99, [50.0, 50.0], 7)]
    df = spark.createDataFrame(pts, "id int, v array<double>, cluster_id int")
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for row in vectors.silhouette_samples(df, "v").collect():
        own = [far(row["v"], v) for i, v, c in pts if c == row["cluster_id"] and i != row["id"]]
        rest = min(sum(d) / len(d) for k in {c for _, _, c in pts} - {row["cluster_id"]} if (d := [far(row["v"], v) for _, v, c in pts if c == k]))
        want = (rest - sum(own) / len(own)) / max(rest, sum(own) / len(own)) if own else 0
        assert row["silhouette_sample"] == pytest.approx(want, abs=1e-4)
    scopes = {"all": (F.col("id") < 99, (2, 3, 4)), "few": (F.col("id") < 3, (3, 4))}
    out = vectors.cluster_scopes(df.drop("cluster_id"), "id", "v", scopes, (1, 2)).collect()
    assert {r["scope"] for r in out} == {"all"} and {r["k"] for r in out} == {3} and len({(r["id"] % 3, r["cluster_id"]) for r in out}) == 3


def test_retries():
    notes, waits = [], []

    def call(job, note):
        notes.append(note)
        if len(notes) < 3:
            raise ValueError("no such code")
        return {"job_family": "X"}

    assert dispatch.retrying(call, sleep=waits.append)({}) == {"job_family": "X"} and waits == [2.5, 2.5]
    assert notes[0] == "" and "no such code" in notes[1]
    assert dispatch.retrying(lambda j, n: 1 / 0, sleep=waits.append)({}) is None


def test_torn_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"source": "s", "source_job_id": "1"}\n{"source": "s", "sour\n')
    assert [r["source_job_id"] for r in postings.bronze(spark, str(tmp_path)).collect()] == ["1"]
    assert [r["line"] for r in postings.malformed(spark, str(tmp_path)).collect()] == ['{"source": "s", "sour']


def test_dispatch_by_threads():
    calls = []

    def call(job):
        calls.append(job["job_id"])
        time.sleep(0.002)
        if len(calls) % 7 == 0:
            raise ValueError("odd answer")
        return {"job_family": job["content_hash"]}

    providers = [dispatch.Provider(x, call) for x in "abc"]
    jobs = [{"job_id": str(i), "content_hash": f"h{i % 40}"} for i in range(60)]
    out = dispatch.dispatch(jobs, providers, workers=dispatch.pool(providers))
    assert sorted(x["job_id"] for x in out) == sorted(j["job_id"] for j in jobs) and len({x["job_family"] for x in out}) == 40
    assert sum(p.used for p in providers) == 40 and dispatch.pool(providers) == 6 and dispatch.pool([]) == 3
    # a job that waits for a call that hangs goes to review
    slow = dispatch.Provider("slow", lambda j: time.sleep(0.4) or {"job_family": "X"})
    out = dispatch.dispatch([{"job_id": "1", "content_hash": "h"}, {"job_id": "2", "content_hash": "h"}], [slow], workers=2, idle=0.1)
    assert sorted((x["job_id"] == "1", x["method"]) for x in out) in ([(False, "manual_review"), (True, "llm:slow")], [(False, "llm:slow"), (True, "manual_review")])


def test_discovery_tables_and_taxonomy(spark):
    texts = spark.createDataFrame(
        [("1", "Data Engineer", ["SQL", "Spark"], "a", "en", "DE", True), ("2", "Senior Data Engineer", ["SQL"], "a", "en", "DE", None), ("3", "Kế toán", [], "b", "vi", "OTHER", False)],
        "job_id string, title string, skills array<string>, source string, lang string, role_category string, is_active boolean",
    )
    clusters = spark.createDataFrame([("1", "all", 0, 0.5), ("2", "all", 0, 0.25), ("3", "all", 1, 0.0), ("3", "other", 0, 0.1), ("9", "other", 0, 0.2)], "job_id string, scope string, cluster_id int, silhouette_sample double")
    tables = discovery.discovery(texts, clusters, ["DE", "OTHER"], {"engineers": "(?i)engineer", "none": "xyz"})
    assert {(r["facet"], r["value"]): r["n"] for r in tables["overview"].collect()} == {("rows", ""): 3, ("active", ""): 1, ("source", "a"): 2, ("source", "b"): 1, ("lang", "en"): 2, ("lang", "vi"): 1, ("role_category", "DE"): 2, ("role_category", "OTHER"): 1}
    assert tables["title_terms"].first()["top"].startswith("data (2), data engineer (2), engineer (2)")
    rows = {(r["scope"], r["cluster_id"]): r for r in tables["clusters"].collect()}
    assert rows["all", 0]["top_skills"] == "SQL (2), Spark (1)" and rows["all", 0]["silhouette"] == 0.375 and rows["other", 0]["n"] == 2 and rows["other", 0]["top_source"] == "b"
    assert [(r["branch"], r["n"], r["n_other"]) for r in tables["branches"].collect()] == [("engineers", 2, 0)]
    said = discovery.report("Found", tables)
    assert "## roles_by_cluster" in said and "| 0 | 2 | 0 |" in said
    functions = [{"code": "DE", "name": "n", "definition": "d", "inclusion": "i", "exclusion": "e"}]
    out = discovery.taxonomy(functions, ["x", "x"], {"split": aggregates.evidence(texts, "title", "(?i)data", senior="Senior")}, status="draft")
    assert out["validation_from_discovery"] == {"split": {"n": 2, "senior": 1, "neither": 1}} and out["domains"] == ["x"] and out["status"] == "draft"
    with pytest.raises(ValueError):
        discovery.taxonomy(functions * 2, [], {})


def test_text_prototypes(spark):
    families = spark.createDataFrame([("DE", "Data Engineer", ["etl"], ["spark"]), ("OTHER", "Other", [], [])], "code string, name string, aliases array<string>, skills array<string>")
    encode = vectors.hashing_encoder(16)
    rows = vectors.text_prototypes(families, encode).collect()
    want = encode(["passage: Data Engineer. etl, spark"])[0]
    assert [r["label"] for r in rows] == ["DE"] and rows[0]["prototype"] == pytest.approx((want / (want @ want) ** 0.5).tolist())
