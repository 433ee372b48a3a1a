"""SimHash near copies, for stages that drop rows: pivot tables of wide fingerprints, verified by
Jaccard similarity of 5-word shingles.

Texts of one set of shingles are one member.  A fingerprint is WORDS fingerprints of 64 bits, each by
hashes of its own: bit i is set if it is set in over half of the shingles' hashes.  At a similarity of LEAST
a bit differs with a probability of 0.16 at most (0.19 for sets of four and five shingles), so two members
meet by blocks of the fingerprint: each key is one block of BLOCK bits, and those that agree in any block meet.
Of BLOCKS blocks (SHORT_BLOCKS for the short sets) a pair of similarity LEAST shares none with a probability
of 2e-8 (2.5e-8).  The blocks are the blocking step; pivots discard, and shingles verify.

* Sets of fewer than four shingles have no near copy but equal ones.  A sample of each longer set's shingles, ASKED
  and more or all, is looked for in the other sets: whoever shares less than a fifth of it (of a near copy
  four fifths are shared; this misses one with a probability of 1e-9) is not fingerprinted.
* A shingle that no other member holds is shared with nobody.  Members left with less than LEAST
  of their shingles are out, and a pair that is out by the smaller rest too (exact).
* Each key has a pivot, the member with the fewest shingles of its own.  The pivot table holds for each member the distance
  of its fingerprint to that of its first pivot, the one that it meets most often, and within RADIUS (over nine standard
  deviations) the shingles that both hold.  Members near their pivots form classes, and nobody is compared within a class.
* What is left are a key's pivot and the members of other classes, then these and whom they meet there.  Of two members of one
  first pivot, a pair is discarded whose distances to it differ by more than RADIUS (triangle inequality), and one that cannot
  share enough: at most the smaller of what they have in common with the pivot and the smaller of what they share
  with anybody else (exact).

So no other pair is ever linked, and classes are those of all pairs that meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talus.llm.common import batches, numbered, publish, release, sliced, small, without_rows
from talus.llm.simhash import components

SIZE, LEAST = 5, 0.8
#: Fingerprints of 64 bits in a member's fingerprint, bits that differ between near copies at most.
WORDS, RADIUS = 32, 553
#: Bits of a block; blocks of a member, and of one of at most SHORT shingles.
BLOCK, BLOCKS, SHORT, SHORT_BLOCKS = 20, 800, 5, 1600
#: Shingles of a set that are looked for in others: so many or up to twice as many, on average.
ASKED = 32
#: Rows of fingerprints up to which they are broadcast (about 300 bytes a row).
BROADCAST_PRINTS = 50_000
_R = np.random.default_rng(42)
_LANES = _R.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_BITS = np.array([_R.choice(64 * WORDS, BLOCK, replace=False) for _ in range(SHORT_BLOCKS)])


def shingles(text: str | None) -> set[bytes]:
    """5-word shingles; a shorter text is one shingle, an empty one none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < SIZE:
        return {b" ".join(words)} if words else set()
    return {b" ".join(x) for x in zip(*(words[i:] for i in range(SIZE)))}


def hashes(text: str | None) -> np.ndarray:
    """The shingles' 64-bit hashes by order, each once."""
    found = shingles(text)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)))


def fingerprint(h: np.ndarray) -> np.ndarray:
    """The bits of WORDS fingerprints: set if set in over half of the hashes of a lane."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(h), 255):  # a byte counts so many
        x = h[at : at + 255, None] + _LANES
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return 2 * ones > len(h)


def keys(bits: np.ndarray, n: int) -> np.ndarray:
    """A key for each block of the fingerprint of n shingles: the block's number and bits."""
    many = SHORT_BLOCKS if n <= SHORT else BLOCKS
    return (np.arange(many) << BLOCK) + bits[_BITS[:many]] @ (1 << np.arange(BLOCK))


def sample(h: np.ndarray) -> tuple[np.ndarray, int]:
    """The hashes (halved) to be found by others, and how many of them, the first, to look for.  Sets that
    may be near differ by less than a factor of two in size: what one looks for, the other one shows."""
    level = max(0, (len(h) // ASKED).bit_length() - 1)
    half, most = h >> np.uint64(1), (1 << 63) - 1
    upto = lambda k: int(np.searchsorted(half, np.uint64(most >> k), side="right"))
    return half[: upto(max(0, level - 1))].view(np.int64), upto(level)


def sketches(rows: DataFrame) -> DataFrame:
    """doc_id, rid, digest of the shingles, their number and sample of numbered rows, published."""
    batches(rows.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(parts):
            found = [hashes(t) for t in b.column("text").to_pylist()]
            shown = [sample(h) for h in found]
            cols = [
                b.column("doc_id"), b.column("rid"), pa.array([xxhash.xxh3_128_digest(h.tobytes()) for h in found], pa.binary()),
                pa.array([len(h) for h in found], pa.int32()), pa.array([x for x, _ in shown], pa.list_(pa.int64())), pa.array([k for _, k in shown], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "rid", "digest", "n", "shown", "asked"])

    return publish(rows.mapInArrow(run, "doc_id long, rid long, digest binary, n int, shown array<long>, asked int"), "sketches")


def worth(one: DataFrame) -> DataFrame:
    """rid of the sketches that may have a near copy, published."""
    one = one.where(F.col("n") >= LEAST * (F.col("n") + 1) - 1e-9)
    # the row and, in the last bit, whether it looks for the shingle
    each = one.select(F.posexplode("shown").alias("at", "h"), (F.col("rid") * 2).alias("row"), "asked").select("h", (F.col("row") + (F.col("at") < F.col("asked")).cast("long")).alias("by"))
    lone = each.groupBy("h").agg(F.min("by").alias("by"), F.max("by").alias("last")).where("by = last and by % 2 = 1")
    lone = lone.groupBy(F.shiftright("by", 1).alias("rid")).agg(F.count("*").alias("alone"))
    found = F.col("asked") - F.coalesce("alone", F.lit(0))
    return publish(one.select("rid", "asked").join(small(publish(lone, "lone")), "rid", "left").where((found > 0) & (5 * found >= F.col("asked"))).select("rid"), "wanted")


def sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """rid and the shingles' hashes of the rows in ``wanted`` (rid), published."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(parts):
            found = [hashes(t).view(np.int64) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array(found, pa.list_(pa.int64()))], ["rid", "held"])

    rows = rows.join(small(wanted), "rid", "left_semi").select("rid", "text")
    return publish(rows.mapInArrow(run, "rid long, held array<long>"), "sets")


def needed(a: Column, b: Column) -> Column:
    """How many shingles sets of such sizes must share to reach the similarity."""
    return LEAST / (1 + LEAST) * (a + b) - 1e-9


def compared(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The published pairs (a, b) with ``both``, the shingles that they share, and ``near``, whether they reach
    the similarity.  Only sets of the pairs move."""
    of = lambda name: held.join(small(publish(pairs.select(F.col(name).alias("rid")).distinct(), "asked")), "rid", "left_semi").select(F.col("rid").alias(name), F.col("held").alias(f"of_{name}"))
    found = of("a").join(small(pairs), "a").join(of("b"), "b").select("a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("both"), needed(F.size("of_a"), F.size("of_b")).alias("least"))
    return publish(found.select("a", "b", "both", (F.col("both") >= F.col("least")).alias("near")), "compared")


def shared(held: DataFrame) -> DataFrame:
    """rid and ``own``: how many of its shingles another member holds too; members that share enough."""
    once = held.select("rid", F.explode("held").alias("h")).groupBy("h").agg(F.count("*").alias("many"), F.min("rid").alias("rid")).where("many = 1")
    alone = once.groupBy("rid").agg(F.count("*").alias("alone"))
    rows = held.select("rid", F.size("held").alias("n")).join(alone, "rid", "left")
    own = (F.col("n") - F.coalesce("alone", F.lit(0))).alias("own")
    return publish(rows.select("rid", "n", own).where(F.col("own") >= LEAST * F.col("n") - 1e-9), "shared")


def prints(held: DataFrame) -> DataFrame:
    """rid, print (the fingerprint's words) and keys of sets, published."""
    batches(held.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            sets_ = [x.values.to_numpy().view(np.uint64) for x in b.column("held")]
            bits = [fingerprint(h) for h in sets_]
            words = [np.packbits(x, bitorder="little").view("<i8") for x in bits]
            each = [keys(x, len(h)) for x, h in zip(bits, sets_)]
            yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array(words, pa.list_(pa.int64())), pa.array(each, pa.list_(pa.int64()))], ["rid", "print", "keys"])

    return publish(held.mapInArrow(run, "rid long, print array<long>, keys array<long>"), "prints")


def measured(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The published pairs (a, b) with the distance of their fingerprints, published."""
    of = lambda name: small(members.select(F.col("rid").alias(name), F.col("print").alias(f"of_{name}")), limit=BROADCAST_PRINTS)
    apart = [F.bit_count(F.get("of_a", F.lit(i)).bitwiseXOR(F.get("of_b", F.lit(i)))) for i in range(WORDS)]
    return publish(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", sum(apart[1:], apart[0]).alias("distance")), "measured")


def labelled(rows: DataFrame, roots: DataFrame, **names: str) -> DataFrame:
    """``rows`` with the class of each of the named columns of rids; a lone member is its own."""
    for name, rid in names.items():
        rows = rows.join(small(roots.select(F.col("node").alias(rid), F.col("root").alias(name))), rid, "left").withColumn(name, F.coalesce(name, rid))
    return rows


def meetings(members: DataFrame, own: DataFrame) -> DataFrame:
    """key, rid and the key's pivot of the keys that two members or more hold, published.  One shuffle of the keys: a key's
    rows are counted where they are sorted.  Pivots are the members with the fewest shingles of their own."""
    rows = members.join(small(own), "rid").select("rid", (F.col("n") - F.col("own")).alias("alone"), F.explode("keys").alias("key"))
    of = Window.partitionBy("key")
    rows = rows.select("key", "rid", F.count("*").over(of).alias("many"), F.min(F.struct("alone", "rid")).over(of).alias("first"))
    return publish(rows.where("many > 1").select("key", "rid", F.col("first.rid").alias("pivot")), "met")


def possible(a: str, b: str) -> Column:
    """Whether two members (n, own, and their first pivot with the distance to it and what they hold in common with it) may
    be near copies that are not compared yet.  Every discard is exact, but for what RADIUS discards."""
    of = lambda name: (F.col(f"{a}.{name}"), F.col(f"{b}.{name}"))
    (n, m), (own, other), (first, second), (far, away), (both, common) = (of(x) for x in ("n", "own", "first", "distance", "both"))
    need = needed(n, m)
    reach = (F.abs(far - away) <= RADIUS) & F.coalesce(F.least(both, common) + F.least(own - both, other - common) >= need, F.lit(True))
    asked = (F.col(f"{a}.rid") == second) | (F.col(f"{b}.rid") == first)
    return (F.least(own, other) >= need) & ~F.coalesce(asked, F.lit(False)) & F.coalesce((first != second) | reach, F.lit(True))


def links(held: DataFrame) -> DataFrame:
    """Links (a, b) among sets (rid, held) that connect exactly the near copies among those that meet."""
    own = shared(held)
    members = prints(held.join(small(own.select("rid")), "rid", "left_semi"))
    met = meetings(members, own)
    # the pivot that each member meets most often
    most = met.where("rid != pivot").groupBy("pivot", "rid").agg(F.count("*").alias("many")).groupBy("rid").agg(F.max(F.struct("many", "pivot")).alias("most"))
    most = publish(most.select(F.col("most.pivot").alias("a"), F.col("rid").alias("b")), "first_pivots")
    apart = measured(most, members)
    verified = compared(publish(apart.where(F.col("distance") <= RADIUS).select("a", "b"), "fitting"), held)
    near = verified.where("near").select("a", "b")
    table = apart.join(small(verified.drop("near")), ["a", "b"], "left").select(F.col("b").alias("rid"), F.col("a").alias("first"), "distance", "both")
    table = publish(own.join(small(table), "rid", "left"), "pivot_table")
    known = lambda name: small(table.select(F.struct(*table.columns).alias(name), F.col("rid").alias(f"{name}_rid")))
    # the other pivots, those of other classes
    others = labelled(met.where("rid != pivot"), publish(components(near), "labels"), r1="pivot", r2="rid").where("r1 != r2").select(F.col("pivot").alias("a_rid"), F.col("rid").alias("b_rid")).distinct()
    others = others.join(known("a"), "a_rid").join(known("b"), "b_rid").where(possible("a", "b"))
    near = publish(near.unionByName(checked(publish(others.select(F.col("a_rid").alias("a"), F.col("b_rid").alias("b")), "other_pivots"), members, held)), "near")
    # members of other classes than a pivot's, and whom they meet at it
    roots = publish(components(near), "labels")
    table = publish(labelled(table, roots, label="rid"), "members")
    rows = labelled(met.where("rid != pivot").join(small(table), "rid"), roots, main="pivot").drop("pivot")
    rows = publish(rows.withColumn("main", F.col("label") == F.col("main")), "rows")
    a, b = rows.where("not main").alias("a"), rows.alias("b")
    once = F.col("b.main") | (F.col("a.rid") < F.col("b.rid"))
    left = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.label") != F.col("b.label")) & once & possible("a", "b"))
    left = publish(left.select(F.least("a.rid", "b.rid").alias("a"), F.greatest("a.rid", "b.rid").alias("b")).distinct(), "left")
    near = publish(near.unionByName(checked(left, members, held)), "near")
    for x in (members, met, rows):
        release(x)
    return near


def checked(pairs: DataFrame, members: DataFrame, held: DataFrame) -> DataFrame:
    """Those of the published pairs (a, b) whose fingerprints are within RADIUS and whose shingles reach the similarity."""
    fits = publish(measured(pairs, members).where(F.col("distance") <= RADIUS).select("a", "b"), "fitting")
    return compared(fits, held).where("near").select("a", "b")


def copies(rows: DataFrame) -> DataFrame:
    """rid of each of the rows (doc_id, text, rid) that is not the first of its class."""
    seen = sketches(rows)
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "rid").alias("place")
    same = publish(seen.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("many")).where("many > 1"), "same")
    equal = publish(seen.join(small(same), "digest").where("rid != first.rid").select("rid"), "equal")
    wanted = worth(seen.join(small(equal), "rid", "left_anti"))
    held = sets(rows, wanted)
    under = components(links(held))  # a class's least node is not among them
    roots = publish(under.unionByName(under.select(F.col("root").alias("node"), "root")).distinct(), "roots")
    of = roots.join(seen.select("doc_id", "rid"), F.col("node") == F.col("rid")).select("root", place)
    firsts = of.groupBy("root").agg(F.min("place").alias("first")).select(F.col("first.rid").alias("node"))
    near = roots.join(firsts, "node", "left_anti").select(F.col("node").alias("rid"))
    gone = publish(equal.unionByName(near), "gone")
    for x in (seen, held):
        release(x)
    return gone


def without_similar(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class of near copies: the smallest id's (its first row; null ids
    come last).  Null and empty texts hold no shingle and are one class; an empty table stays empty."""
    rows = numbered(docs)
    return without_rows(rows, docs.columns, copies(rows.select("row.doc_id", "row.text", "rid")))
