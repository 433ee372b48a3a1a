"""Tables on disk, settings, artefacts and streams."""

import json
from datetime import datetime


from talus.sources import config, sinks
from talus.streaming import arrivals


def test_versions_and_snapshots(spark, tmp_path):
    root = str(tmp_path / "table")
    assert sinks.latest(spark, root) is None
    schema = "source_job_id string, ingested_at timestamp, description_raw string, skills_raw array<string>, extra string"
    old = spark.createDataFrame([("1", datetime(2026, 1, 1), "said", ["a"], "x"), ("2", datetime(2026, 1, 1), "gone", [], "x")], schema)
    first = sinks.write_version(old, root)
    assert sinks.latest(spark, root).endswith(first.rpartition("/")[2])
    now = spark.createDataFrame([("1", datetime(2026, 1, 3), "later", ["z"], "y"), ("1", datetime(2026, 1, 2), "", [], "y"), ("3", datetime(2026, 1, 2), None, None, "y")], schema)
    out = {r["source_job_id"]: r for r in sinks.snapshot(now, spark.read.parquet(sinks.latest(spark, root))).collect()}
    assert set(out) == {"1", "3"} and (out["1"]["description_raw"], out["1"]["skills_raw"], out["1"]["extra"]) == ("said", ["a"], "y") and out["3"]["description_raw"] is None
    details = spark.createDataFrame([("1", "filled"), ("9", "nobody")], "source_job_id string, description_raw string")
    assert {r["source_job_id"]: r["description_raw"] for r in sinks.enrich(old, details).collect()} == {"1": "said", "2": "gone"}
    assert {r["source_job_id"]: r["description_raw"] for r in sinks.enrich(now.where("extra = 'y' and ingested_at < '2026-01-03'"), details).collect()} == {"1": "filled", "3": None}
    sinks.csv(old.select("source_job_id", "extra"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2


def test_settings_and_artefacts(tmp_path):
    path = str(tmp_path / "c.yml")
    sinks.yaml_file({"defaults": {"pages": 3, "enabled": True}, "sources": {"a": {"pages": 5}, "b": {"enabled": False}}}, path)
    c = config.load(path)
    assert config.overlaid(c, "a") == {"pages": 5, "enabled": True} and config.enabled(c) == ["a"]
    assert config.aliases({"skills": {"SQL": {"aliases": ["My  SQL", ""]}, "MySQL": {"aliases": ["my sql"]}, "R": None}}) == {"sql": "SQL", "my sql": "MySQL", "mysql": "MySQL", "r": "R"}
    assert config.rules({"rules": [{"role": "DE", "patterns": ["x", 1]}]}, "role") == [("DE", ["x", "1"])]
    tree = {"domains": [{"code": "D", "subdomains": [{"code": "S", "families": [{"code": "F", "name": "Fam", "aliases": ["A B"]}]}]}]}
    assert config.families(tree) == [{"domain": "D", "subdomain": "S", "code": "F", "name": "Fam", "aliases": ["a b"], "typical_skills": [], "sparse": False}]
    sinks.text("report", str(tmp_path / "r.md"))
    noted = config.note(str(tmp_path / "manifest"), str(tmp_path / "r.md"), 1, "report/1", "test")
    assert json.loads((tmp_path / "manifest").read_text()) == noted and len(noted["sha256"]) == 64


def test_streams(spark, tmp_path):
    schema = "ts timestamp, user string"
    day = lambda d, h: datetime(2026, 1, d, h)
    path = str(tmp_path / "in")
    spark.createDataFrame([(day(1, 1), "a"), (day(1, 5), "a"), (day(1, 6), "b"), (day(2, 1), "a")], schema).coalesce(1).write.parquet(path)

    def run(df, name):
        q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).outputMode("complete" if name == "counts" else "append").trigger(availableNow=True).start()
        q.awaitTermination(60)
        return spark.table(name).collect()

    got = run(arrivals.windowed_counts(arrivals.files(spark, schema, path), "ts", "user"), "counts")
    assert {(r["start"].day, r["user"], r["n"]) for r in got} == {(1, "a", 2), (1, "b", 1), (2, "a", 1)}
    assert sorted(r["user"] for r in run(arrivals.first_seen(arrivals.files(spark, schema, path), "user", "ts", "7 days"), "seen")) == ["a", "b"]
