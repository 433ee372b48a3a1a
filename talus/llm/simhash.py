"""SimHash near-dedup with pivot distance tables.

Pivots are reference fingerprints: the zero fingerprint, one for each of 32 blocks of two bits
(ones there, zeros elsewhere), and spread-out codes.  The table holds each distinct fingerprint's
distances to all of them.

Candidates come from the distances to zero and to the block pivots.  A block's coordinate, half of
what separates its pivot's distance from zero's, moves by at most the differing bits of the block, so
at most RADIUS of the 32 coordinates differ between two fingerprints that are linked.  The coordinates
are dealt to GROUPS groups; those that are linked agree in all but RADIUS of them, so they meet under
one of the keys that leave out as many.

Candidates are then discarded by the distances to the spread-out pivots, which differ by at most
RADIUS (triangle inequality): under a key, a distance counts in its own band of RADIUS + 1 and in
the band that it reaches upwards, so that two that may be linked share a band of each pivot, and
whoever shares none with another one under any key is out.  Survivors are verified exactly: two
fingerprints differ in at most two bits if and only if they have a one-bit neighbour (or
themselves) in common, so each is written to its 65 neighbours and those that meet there are linked
to the least of them.  Nothing pairs the fingerprints of a key, so nothing grows with the
square of one, and every key goes the same way, however many hold it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.llm.common import batches, numbered, publish, release, sliced, small, without_rows

#: RADIUS is what one-bit neighbours verify.
BITS, BLOCK, RADIUS = 64, 2, 2
BLOCKS, GROUPS = BITS // BLOCK, 6
#: Pivots of the discarding step.
SPREAD = 3
#: Links that a worker contracts at a time.
CHUNK = 500_000
_MASK = (1 << 64) - 1


def shingles(text: str | None) -> list[bytes]:
    """3-word shingles, repeats included; a shorter text is one shingle, an empty one none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < 3:
        return [b" ".join(words)] if words else []
    return [b"%b %b %b" % x for x in zip(words, words[1:], words[2:])]


def fingerprint(text: str | None) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; no shingle: zero."""
    found = shingles(text)
    if not found:
        return 0
    h = np.fromiter(map(_hash, found), np.uint64, len(found))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 65_536):
        ones += np.unpackbits(h[at : at + 65_536, None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _hash(x: bytes) -> int:
    return xxhash.xxh64_intdigest(x, 42)


def pivots() -> list[int]:
    """Zero, the blocks, and SPREAD codes from a fixed generator (signed 64-bit)."""
    out, x = [0] + [((1 << BLOCK) - 1) << i * BLOCK for i in range(BLOCKS)], 42
    for _ in range(SPREAD):
        x = (x + 0x9E3779B97F4A7C15) & _MASK
        y = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        y = ((y ^ (y >> 27)) * 0x94D049BB133111EB) & _MASK
        out.append(y ^ (y >> 31))
    return [signed(v) for v in out]


def signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def fingerprints(docs: DataFrame, rid: Column | None = None) -> DataFrame:
    """doc_id, fp (signed 64-bit), rid (``rid``, or else the row's number in the scan), published."""
    batches(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(parts):
            fp = np.array([fingerprint(t) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp), b.column("rid")], ["doc_id", "fp", "rid"])

    rows = docs.select("doc_id", "text", (F.monotonically_increasing_id() if rid is None else rid).alias("rid"))
    return publish(rows.mapInArrow(run, "doc_id long, fp long, rid long"), "fingerprints")


def table(fps: DataFrame) -> DataFrame:
    """The pivot distance table of distinct fingerprints: fp, zero (to the zero pivot), near (to
    the block pivots) and far (to the spread-out ones)."""
    refs = [distance(F.col("fp"), F.lit(p)) for p in pivots()]
    return fps.select("fp", refs[0].alias("zero"), F.array(*refs[1 : 1 + BLOCKS]).alias("near"), F.array(*refs[1 + BLOCKS :]).alias("far"))


def keys() -> tuple[list[Column], Column]:
    """The groups' numbers of a row of the table, and from these (as g0, g1 and so on) its keys: one
    for each choice of groups that agree."""
    # (zero - near + BLOCK) / 2 is 0 to BLOCK: a group's coordinates are digits of one number
    digit = lambda i: F.shiftright(F.col("zero") - F.get("near", F.lit(i)) + BLOCK, 1).cast("long")
    dealt = [range(g, BLOCKS, GROUPS) for g in range(GROUPS)]
    number = [sum((digit(i) * (BLOCK + 1) ** k for k, i in enumerate(d)), F.lit(0).cast("long")) for d in dealt]
    out = []
    for k, held in enumerate(combinations(range(GROUPS), GROUPS - RADIUS)):
        value = F.lit(k).cast("long")
        for g in held:
            value = value * (BLOCK + 1) ** len(dealt[g]) + F.col(f"g{g}")
        out.append(value)
    return number, F.array(*out)


def candidates(fps: DataFrame) -> DataFrame:
    """The fingerprints that may be linked to another one: by keys, then by the spread-out pivots."""
    number, each = keys()
    rows = table(fps).select("fp", "far", *[n.alias(f"g{g}") for g, n in enumerate(number)]).select("fp", "far", F.explode(each).alias("key"))
    rows = publish(rows, "pivot_table")
    held = publish(rows.groupBy("key").agg(F.count("*").alias("held")).where("held > 1").select("key"), "shared_keys")
    band = lambda j, up: F.floor((F.get("far", F.lit(j)) + (RADIUS if up else 0)) / (RADIUS + 1))
    bands = F.array_distinct(F.array(*[F.xxhash64("key", *[band(j, up) for j, up in enumerate(ups)]) for ups in product((False, True), repeat=SPREAD)]))
    met = publish(rows.join(small(held), "key").select("fp", F.explode(bands).alias("band")), "bands")
    both = publish(met.groupBy("band").agg(F.count("*").alias("held")).where("held > 1").select("band"), "shared_bands")
    found = publish(met.join(small(both), "band").select("fp").distinct(), "candidates")
    for x in (rows, held, met, both):
        release(x)
    return found


def links(fps: DataFrame) -> DataFrame:
    """Links (a < b) among distinct fingerprints that connect exactly those within the radius:
    each fingerprint's to the least one that shares a one-bit neighbour (or itself) with it."""
    flips = F.transform(F.array(*[F.lit(v) for v in (0, *[signed(1 << i) for i in range(BITS)])]), lambda m: F.col("fp").bitwiseXOR(m))
    rows = candidates(fps).select("fp", F.explode(flips).alias("mid"))
    low = rows.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("mid", "a")
    return publish(rows.join(low, "mid").where("a < fp").select("a", F.col("fp").alias("b")).distinct(), "links")


def contract(edges: DataFrame) -> DataFrame:
    """The same components by fewer links: those of each chunk of a partition, each node to its least."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            at = x
            while (up := root.setdefault(at, at)) != at:
                at = up
            while root[x] != at:
                root[x], x = at, root[x]
            return at

        def out() -> pa.RecordBatch:
            found = [(find(x), x) for x in root]
            both = [(a, b) for a, b in found if a != b]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in both], pa.int64()) for k in (0, 1)], ["a", "b"])

        for p in parts:
            for a, b in zip(p.column("a").to_pylist(), p.column("b").to_pylist()):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
            if len(root) > CHUNK:
                yield out()
                root.clear()
        if root:
            yield out()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node that is not the least reachable from it, by alternating large and
    small stars over contracted links.

    Every round is published, so a lost executor never unwinds earlier rounds; the round before goes.
    """
    now = publish(contract(edges), "contracted")
    if not now.take(1):
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    last = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a and b > low").select(F.col("low").alias("a"), "b").distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("low"))
        tie = down.join(least, "u")
        then = publish(
            tie.select(F.col("low").alias("a"), F.col("u").alias("b")).unionByName(tie.where("v > low").select(F.col("low").alias("a"), F.col("v").alias("b"))).distinct(),
            "stars",
        )
        release(now)
        now, state = then, then.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last or state[0] == 0:
            break
        last = state
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))


def classes(docs: DataFrame, rid: Column | None = None) -> DataFrame:
    """A row for each document row: doc_id, fp, rid, component_id, winner (the rid that stays).

    Only fingerprints of classes of two rows or more are joined back; a lone row is its own class.
    """
    rows = fingerprints(docs, rid)
    low = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "rid")).alias("low")
    same = publish(rows.groupBy("fp").agg(low, F.count("*").alias("n")), "distinct")
    roots = components(links(same.select("fp")))
    joined = same.join(roots, same["fp"] == roots["node"], "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("low").alias("win"), F.sum("n").alias("held")).where("held > 1").select(F.col("root").alias("__root"), "win")
    of = publish(joined.join(least, F.col("root") == F.col("__root")).select(F.col("fp").alias("__fp"), F.col("win.doc_id").alias("least"), F.col("win.rid").alias("first")), "classes")
    alone = F.col("__fp").isNull()
    return rows.join(small(of), F.col("fp") == F.col("__fp"), "left").select(
        "doc_id", "fp", "rid", F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), F.when(alone, F.col("rid")).otherwise(F.col("first")).alias("winner")
    )


def near_copies(docs: DataFrame) -> DataFrame:
    """A row for each document row: doc_id, fingerprint, component_id.

    Null and empty texts have fingerprint zero, linked like any other.  Null ids count after
    all others (a class of null ids alone has a null component_id).
    """
    return classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the smallest id's (its first row; null ids come last).

    Null and empty texts are one class; an empty table stays empty.
    """
    rows = numbered(docs)
    found = classes(rows.select("row.doc_id", "row.text", F.col("rid").alias("__rid")), F.col("__rid"))
    return without_rows(rows, docs.columns, found.where("rid != winner"))
