"""Sinks: versioned tables, snapshots with carried-forward fields, CSV, text and YAML artefacts."""

from __future__ import annotations

import uuid

import yaml
from pyspark.sql import DataFrame, SparkSession

from talus.operators.cdc import carry_forward, first_wins


def write_version(df: DataFrame, root: str) -> str:
    """A new version directory of a table; a version is complete once its _SUCCESS file is there,
    so a table can be read while its next version is made of it."""
    path = f"{root}/v-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def latest(spark: SparkSession, root: str) -> str | None:
    """The newest complete version."""
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return None
    done = [(s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(base) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath().toString() + "/_SUCCESS"))]
    return max(done)[1] if done else None


def snapshot(df: DataFrame, previous: DataFrame | None, key: str = "source_job_id") -> DataFrame:
    """A source's new snapshot: blank descriptions and skills come from the previous one."""
    now = first_wins(df, [key], "ingested_at")
    return now if previous is None else carry_forward(now, previous, key, ["description_raw", "skills_raw"])


def enrich(df: DataFrame, details: DataFrame, key: str = "source_job_id") -> DataFrame:
    """Fields of details fill only what is blank."""
    return carry_forward(df, details, key, [c for c in details.columns if c != key])


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def text(body: str, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.write(body)


def yaml_file(data: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(data, f, allow_unicode=True, sort_keys=False)
