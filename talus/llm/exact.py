"""Exact dedup against a minimal perfect hash over historical digests.

Historical distinct digests are dealt to shards by prefix; a shard is one row of the
index: the bit levels of its minimal perfect hash, and a slot table of full digests
(32 bytes each) and winner locators (the smallest id).  Arrivals, one row for each
distinct digest, look their slot up and compare all bytes: equal ones are repeats of
the slot's winner, the others are grouped by digest on their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.llm.common import numbered, power_of_two, publish, small, text_of, without_rows

#: Digests of a shard on average, at most (32 + 8 bytes each, and about 3 bits of levels).
SHARD = 16_384
INDEX = "shard long, levels array<binary>, digests binary, winners binary"
LOOKED = "digest binary, keep long, keep_rid long, n long"
_MIX = 0x9E3779B97F4A7C15


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space (a lone space stays as it is)."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _spots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Spots of 64-bit keys in a level of ``size`` bits (a power of two)."""
    x = (keys[:, 0] + np.uint64(level * _MIX % 2**64)) ^ (keys[:, 1] >> np.uint64(level % 31))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_MIX)
    return ((x ^ (x >> np.uint64(32))) & np.uint64(size - 1)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash by levels of bits: a key sits at the first level where it is alone.

    Its slot is the number of set bits before its spot, over all levels.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = [np.concatenate(([0], np.cumsum(x))) for x in levels]
        self.before = np.concatenate(([0], np.cumsum([int(x.sum()) for x in levels])))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: (n, 4) uint64, distinct rows."""
        levels = []
        while len(keys):
            size = max(8, power_of_two(2 * len(keys)))
            spots = _spots(keys, len(levels), size)
            hits = np.bincount(spots, minlength=size)
            levels.append(hits == 1)
            keys = keys[hits[spots] != 1]
            if len(levels) > 62:
                raise ValueError("digests that agree in 128 bits")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots; -1 if no level has the key.  A foreign key may get a slot: compare its bytes."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for i, level in enumerate(self.levels):
            spots = _spots(keys[open_], i, len(level))
            here = level[spots]
            out[open_[here]] = self.before[i] + self.ranks[i][spots[here]]
            open_ = open_[~here]
        return out

    def packed(self) -> list[bytes]:
        return [np.packbits(x).tobytes() for x in self.levels]

    @classmethod
    def unpacked(cls, packed: list[bytes]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in packed])


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = _keys(pdf["digest"])
    table = PerfectHash.build(keys)
    order = np.argsort(table.slots(keys))
    winners = np.stack([pdf["keep"].to_numpy(np.int64), pdf["keep_rid"].to_numpy(np.int64)], axis=1)
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "levels": [table.packed()], "digests": [keys[order].tobytes()], "winners": [winners[order].tobytes()]})


def _look(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    if not len(new):
        return pd.DataFrame({"digest": [], "keep": [], "keep_rid": [], "n": []})
    out = new[["digest", "keep", "keep_rid", "n"]].copy()
    if len(index):
        keys = _keys(new["digest"])
        digests = np.frombuffer(index["digests"].iloc[0], dtype="<u8").reshape(-1, 4)
        winners = np.frombuffer(index["winners"].iloc[0], dtype="<i8").reshape(-1, 2)
        slot = PerfectHash.unpacked(index["levels"].iloc[0]).slots(keys)
        member = slot >= 0
        member[member] = (digests[slot[member]] == keys[member]).all(axis=1)
        for k, name in enumerate(("keep", "keep_rid")):
            out[name] = out[name].astype("Int64").mask(member, pd.Series(winners[np.where(member, slot, 0), k], index=out.index))
    return out


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """A row for each shard from the distinct digests (digest, keep, keep_rid) of the past."""
    return history.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(_build, INDEX)


def look_up(arrivals: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Arrivals (one row a digest) with the winner of the past, where there is one."""
    left = arrivals.withColumn("shard", _shard(shards)).groupBy("shard")
    return left.cogroup(index.groupBy("shard")).applyInPandas(_look, LOOKED)


def _shard(shards: int) -> Column:
    return F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % shards


def digests(docs: DataFrame, rid: Column | None = None) -> DataFrame:
    """doc_id, digest (32 bytes) and the row's number (``rid``, or else one given here), published."""
    digest = F.unhex(F.sha2(normalised(text_of()), 256))
    rid = F.monotonically_increasing_id() if rid is None else rid
    return publish(docs.select("doc_id", digest.alias("digest"), rid.alias("rid")), "digests")


def _first(rows: DataFrame) -> DataFrame:
    """A row for each digest: the smallest id (null last), the first of its rows, the count."""
    low = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "rid")).alias("low")
    return rows.groupBy("digest").agg(low, F.count("*").alias("n")).select("digest", F.col("low.doc_id").alias("keep"), F.col("low.rid").alias("keep_rid"), "n")


def groups(rows: DataFrame, split: int | None = None) -> DataFrame:
    """A row for each distinct digest: keep, keep_rid, n.  Ids up to ``split`` are the past
    (default: the middle between the least and the largest id)."""
    about = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    lo, hi, total = about
    cut = split if split is not None else (0 if lo is None else (lo + hi) // 2)
    shards = max(256, power_of_two(total // SHARD))
    is_past = F.coalesce(F.col("doc_id") <= cut, F.lit(False))
    past = publish(_first(rows.where(is_past)), "past")
    index = publish(build_index(past, shards), "perfect_hash")
    looked = look_up(_first(rows.where(~is_past)), index, shards)
    low = F.min(F.struct(F.col("keep").isNull().alias("null"), "keep", "keep_rid")).alias("low")
    return past.unionByName(looked).groupBy("digest").agg(low, F.sum("n").alias("n")).select("digest", F.col("low.keep").alias("keep"), F.col("low.keep_rid").alias("keep_rid"), "n")


def dedup(docs: DataFrame, split: int | None = None, rid: Column | None = None) -> DataFrame:
    """A row for each document row: doc_id, keep_id, group_size, kept, text_sha256 (and rid).

    Null and empty texts are equal.  Null ids come after all others.  Of repeated rows (one
    id, equal texts) exactly one is kept.  The join back is by digest; a digest of very many
    rows is a large partition of that join, which adaptive execution splits.
    """
    rows = digests(docs, rid)
    found = publish(groups(rows, split).where("n > 1"), "repeats")
    found = small(found.withColumnRenamed("digest", "__digest"))
    out = rows.join(found, F.col("digest") == F.col("__digest"), "left")
    alone = F.col("__digest").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "rid",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``dedup`` drops: null and empty texts are equal, null ids come
    after all others, of repeated rows one stays; an empty table stays empty."""
    rows = numbered(docs)
    found = dedup(rows.select("row.doc_id", "row.text", F.col("rid").alias("__rid")), rid=F.col("__rid"))
    return without_rows(rows, docs.columns, found.where(~F.col("kept")))
