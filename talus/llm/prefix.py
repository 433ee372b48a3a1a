"""Document fingerprints from prefix polynomial hashes.

``P[i] = sum(c[j] * B**j for j < i) mod p`` for two bases, p = 2**31 - 1.  The hash of any span
follows from two entries, brought to the power zero, so that spans of different places compare;
the longest common extension of two places is found by binary search over span hashes.

A document's fingerprint is the hash of its whole text and a bottom-k sketch over the hashes of
all spans of WINDOW code points; one of fewer than SHORT code points has a second sketch, of all its
spans of one and two.  The likeness of two fingerprints estimates the share of spans in common
(Dice), from the fingerprints alone: of short spans if both texts are short, else of long ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talus.llm.common import batches, sliced, text_of

P = np.uint64(2**31 - 1)
BASES = (1_000_003, 786_433_511)
#: Code points of a span: few enough that texts of some words hold several, enough that unrelated texts share few.
WINDOW = 9
#: Below so many code points a text also has a sketch of its spans of one and two.
SHORT = 64
SKETCH = 64
#: Code points that are worked on at a time; what a text's arrays take beyond that is 12 bytes a code point.
CHUNK = 1 << 20
#: Text of a partition, about, in code points; partitions at most (longer ones then); rows sampled for each.
PART_CHARS, PARTS, SAMPLED = 6_000_000, 20_000, 40
#: What a row counts beside its text.
ROW_CHARS = 16
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, lce_edited long"



@lru_cache(maxsize=1)
def _ladders() -> tuple[list[np.ndarray], list[np.ndarray]]:
    """B**j and B**-j mod p for j up to CHUNK, of each base."""

    def ladder(b: int) -> np.ndarray:
        x = np.array([1, b], np.uint64)
        while len(x) < CHUNK:
            x = np.concatenate((x, x * (x[-1] * x[1] % P) % P))
        return x[:CHUNK].astype(np.uint32)

    return [ladder(b) for b in BASES], [ladder(pow(b, -1, int(P))) for b in BASES]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Prefix:
    """Prefix hashes of a text's code points (each counts as its number and one)."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.sums = [np.zeros(self.n + 1, np.uint32) for _ in BASES]
        for base, ladder, sums in zip(BASES, _ladders()[0], self.sums):
            for at in range(0, self.n, CHUNK):
                part = codes[at : at + CHUNK].astype(np.uint64) + np.uint64(1)
                part *= ladder[: len(part)]
                part %= P
                if at:
                    part *= np.uint64(pow(base, at, int(P)))
                    part %= P
                np.cumsum(part, out=part)
                part += np.uint64(sums[at])
                sums[at + 1 : at + 1 + len(part)] = part % P

    def span(self, i: int, length: int) -> tuple[int, ...]:
        """The place-free hash of one span."""
        p = int(P)
        return tuple((int(s[i + length]) - int(s[i])) * pow(b, -i, p) % p for b, s in zip(BASES, self.sums))

    def windows(self, width: int, at: int) -> np.ndarray:
        """Place-free 62-bit hashes of the spans of ``width`` from ``at`` on, CHUNK at most."""
        to = min(self.n - width + 1, at + CHUNK)
        out = np.zeros(to - at, np.uint64)
        for base, ladder, sums in zip(BASES, _ladders()[1], self.sums):
            raw = sums[at + width : to + width].astype(np.uint64) + P
            raw -= sums[at:to]
            raw %= P
            raw *= ladder[: len(raw)]
            raw %= P
            if at:
                raw *= np.uint64(pow(base, -at, int(P)))
                raw %= P
            out <<= np.uint64(31)
            out |= raw
        return out


def equal(a: Prefix, i: int, b: Prefix, j: int, length: int) -> bool:
    """Whether the spans of a from i and of b from j are equal."""
    return i + length <= a.n and j + length <= b.n and a.span(i, length) == b.span(j, length)


def extension(a: Prefix, i: int, b: Prefix, j: int) -> int:
    """The longest common extension of a from i and b from j, by binary search."""
    lo, hi = 0, min(a.n - i, b.n - j)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if equal(a, i, b, j, mid) else (lo, mid - 1)
    return lo


def _normal(spans: np.ndarray) -> np.ndarray:
    x = (spans ^ (spans >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def sketch(hashes: np.ndarray, k: int = SKETCH) -> np.ndarray:
    """The k least distinct hashes, sorted."""
    take = 4 * k
    while take < len(hashes):
        low = np.unique(np.partition(hashes, take)[:take])
        if len(low) >= k:
            return low[:k]
        take *= 8
    return np.unique(hashes)[:k]


def sketched(prefix: Prefix, *widths: int) -> np.ndarray:
    """The sketch of all spans of the widths (a text shorter than one: of the text itself; empty: none)."""
    if not prefix.n:
        return np.zeros(0, np.uint64)
    found = [sketch(_normal(prefix.windows(w, at))) for w in {min(w, prefix.n) for w in widths} for at in range(0, prefix.n - w + 1, CHUNK)]
    return found[0] if len(found) == 1 else sketch(np.concatenate(found))


def fingerprint(prefix: Prefix) -> str:
    """n_chars, the whole text's hash, the sketch and a short text's second one, in hex, parted by ``-`` and ``.``."""
    whole = 0
    for s in prefix.sums:
        whole = whole << 31 | int(s[-1])
    hexed = lambda x: ".".join(f"{v:x}" for v in x.tolist())
    return f"{prefix.n:x}-{whole:x}-{hexed(sketched(prefix, WINDOW))}" + (f"-{hexed(sketched(prefix, 1, 2))}" if prefix.n < SHORT else "")


def likeness(a: str, b: str) -> float:
    """Dice of the spans of two fingerprinted texts, estimated; 1 if the fingerprints are equal."""
    if a == b:
        return 1.0
    parts = a.split("-"), b.split("-")
    of = 3 if all(len(x) == 4 for x in parts) else 2
    x, y = (np.array([int(v, 16) for v in s[of].split(".") if v], np.uint64) for s in parts)
    if not len(x) or not len(y):
        return 0.0
    low = np.union1d(x, y)[:SKETCH]
    j = len(np.intersect1d(np.intersect1d(x, y, True), low, True)) / len(low)
    return round(2 * j / (1 + j), 6)


def edited(text: str, after: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of ``after``."""
    k = len(text) // 2
    return text[: len(text) - k] + after[:k]


PLACE = "struct<key:long,h:long,salt:long>"


def cuts(rows: DataFrame, part_chars: int = PART_CHARS) -> list[tuple[int, int, int]]:
    """Places (key, h, salt) at which ranges of about ``part_chars`` of text begin, but for the first.

    They are taken from a sample by hash, in proportion to the length of texts, of about SAMPLED rows a
    range: they only deal out the work, and any of them is right.
    """
    size = F.length("text") + ROW_CHARS
    total = rows.agg(F.sum(size)).first()[0] or 0
    parts = min(PARTS, total // part_chars + 1)
    if parts < 2:
        return []
    step = total / (parts * SAMPLED)
    draw = F.pmod(F.xxhash64(F.lit("cut"), "place"), F.lit(1 << 30)) / float(1 << 30)
    weight = F.greatest(size.cast("double"), F.lit(step))
    found = sorted((tuple(r[0]), r[1]) for r in rows.where(draw < size / step).select("place", weight).collect())
    if not found:
        return []
    upto = np.cumsum([w for _, w in found])
    at = np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts)
    return sorted({found[i][0] for i in at.tolist()})


def in_order(docs: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """range, guest, doc_id, text: documents in ascending ids, dealt to ranges; each range's rows
    stand sorted in one partition and end with a guest, the next range's first row (the last
    range's guest is the very first row).  Null ids come first; of equal ids the order is by a hash of the
    text, and equal rows are dealt out by their place in the scan, so that no id makes a range of its
    own.  Each text moves once.
    """
    spark = docs.sparkSession
    place = F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), F.xxhash64(text_of()).alias("h"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    rows = docs.select(place.alias("place"), "doc_id", text_of().alias("text"))
    starts = cuts(rows, part_chars)
    # a search in two steps: among every wide-th start, then among those up to the next one
    wide = max(1, int(len(starts) ** 0.5))
    table = spark.createDataFrame([(starts[::wide], [starts[i : i + wide] for i in range(0, len(starts), wide)])], f"tops array<{PLACE}>, each array<array<{PLACE}>>")
    before = lambda x: F.size(F.filter(x, lambda c: c <= F.col("place")))
    top = F.col("top") - 1
    found = F.when(F.col("top") > 0, top * wide + before(F.get("each", top))).otherwise(0)
    rows = rows.crossJoin(F.broadcast(table)).withColumn("top", before(F.col("tops")))  # one row, PARTS places at most
    rows = rows.select("place", "doc_id", "text", found.cast("int").alias("range"))
    first = {r[0]: (r[1], r[2]) for r in rows.groupBy("range").agg(F.min(F.struct("place.key", "place.h")).alias("low")).select("range", "low.key", "low.h").collect()}
    order = sorted(first)
    guests_of = spark.createDataFrame([(r, order[i - 1], *first[r]) for i, r in enumerate(order)], "__range int, __before int, __key long, __h long")
    on = (F.col("range") == F.col("__range")) & (F.col("place.key") == F.col("__key")) & (F.col("place.h") == F.col("__h"))
    guests = rows.join(F.broadcast(guests_of), on).groupBy("__before").agg(F.min("text").alias("text"))  # a row a range
    both = rows.select("range", F.lit(0).alias("guest"), "place.key", "place.h", "doc_id", "text").unionByName(
        guests.select(F.col("__before").alias("range"), F.lit(1).alias("guest"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("h"), F.lit(None).cast("long").alias("doc_id"), "text")
    )
    return both.repartitionById(len(starts) + 1, F.col("range")).sortWithinPartitions("range", "guest", "key", "h", "text").select("range", "guest", "doc_id", "text")


def fingerprints(docs: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """A row for each document row: its fingerprint, its edited text's, and likenesses.

    ``lce_edited`` is the longest common extension of text and edited text from their starts.
    A null text is empty; a lone document follows itself; near_* is 1 for two empty texts and 0
    where one alone is empty.  Ties and null ids stand in the order of ``in_order``.
    """
    batches(docs.sparkSession)
    names = [x.strip().split(" ")[0] for x in RESULT.split(",")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in sliced(parts):
            out = []
            for guest, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("guest", "doc_id", "text"))):
                own = Prefix(points(text))
                now = doc_id, text, own, fingerprint(own)
                if last is not None:
                    out.append(_row(last, text, now[3]))
                last = None if guest else now
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * len(names), types)], names)

    return in_order(docs, part_chars).mapInArrow(run, RESULT)


def _row(of: tuple, after: str, after_print: str) -> tuple:
    doc_id, text, own, print_ = of
    new = edited(text, after)
    changed = Prefix(points(new))
    other = fingerprint(changed)
    return doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), print_, other, likeness(print_, other), likeness(print_, after_print), extension(own, 0, changed, 0)
