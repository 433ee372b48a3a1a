"""Packing by cutting-stock column generation.

A document's ids are cut into full sequences, a body (a multiple of GRAIN) and a tail
(shorter than GRAIN), so that all pieces fall into about a hundred exact lengths.  Over the
histogram of lengths, a linear program picks how often to use which pattern of lengths; a
knapsack dynamic program over the dual prices finds each better column.  Rounded-down
patterns take pieces by their rank in their length; the few pieces that rounding leaves are
placed by first fit decreasing.  Only the histogram and the patterns reach the driver.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talus.llm.common import batches, publish, sliced, text_of

CAPACITY = 2048
GRAIN = 64
END_ID = 1
#: Chunks that a Python worker remembers before it starts afresh.
REMEMBERED = 600_000
#: The split of byte-level BPE files that name no own pattern (a fixed value of the format).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, nth long"
#: White space after a space: there a text is not cut.
ODD = re.compile(r" \s")


class Encoder:
    """Ids of whole texts as little-endian bytes; repeated chunks are encoded once.

    A text is cut before each space that a non-space follows: the tokenizer's own splitting
    never joins across such a place, so the ids are those of the whole text.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        model = json.load(open(path, encoding="utf-8"))["model"]
        raw = _raw_bytes()
        ranks = {bytes(raw[c] for c in t): i for t, i in model["vocab"].items()}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        # where ids rank the merges, chunks of common scripts may be merged by rank directly
        self.by_rank = [model["vocab"][t] for t in merged] == list(range(256, 256 + len(merged)))
        self.fast = tiktoken.Encoding("by_rank", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if self.by_rank else None
        self.sizes = np.zeros(1 + max(ranks.values()), np.int64)
        for t, i in ranks.items():
            self.sizes[i] = len(t)

    def one(self, chunk: str) -> bytes:
        return np.array(self.whole.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, fresh: set[str]) -> None:
        """Encode new chunks: those with a leading space and common letters all in one string, as
        no token crosses their borders; the others one by one."""
        plain = [c for c in fresh if c[0] == " " and (c.isascii() or max(c) < "\u0250") and "<|" not in c] if self.by_rank else []
        if plain:
            ids = np.array(self.fast.encode_ordinary("".join(plain)), "<u4")
            raw = ids.tobytes()
            ends = np.cumsum([len(c.encode()) for c in plain])
            at = (4 * np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 4).tolist()
            self.known.update(zip(plain, [raw[i:j] for i, j in zip([0, *at], at)]))
        for c in fresh.difference(plain):
            self.known[c] = self.one(c)

    def encode_batch(self, texts: list[str], remembered: int = REMEMBERED) -> list[bytes]:
        if len(self.known) > remembered:
            self.known = {}
        split = [self.chunks(t) for t in texts]
        self.learn(set().union(*split).difference(self.known))
        known = self.known
        return [b"".join([known[c] for c in parts]) for parts in split]

    def chunks(self, text: str) -> list[str]:
        """Chunks, each but the first with its leading space."""
        if any(s in text for s in self.special):
            return [text]
        parts = text.split(" ")
        out = [parts[0]]
        if "" not in parts and not ODD.search(text):
            out += [" " + p for p in parts[1:]]
        else:
            for p in parts[1:]:
                if p and not p[0].isspace():
                    out.append(" " + p)
                else:
                    out[-1] += " " + p
        return out if out[0] else out[1:]


def _raw_bytes() -> dict[str, int]:
    """The bytes that a byte-level vocabulary's characters stand for: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cuts(n: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Lengths of a document's pieces: full sequences, a body, a tail."""
    full, rest = divmod(n, capacity)
    body = rest // grain * grain
    return [capacity] * full + [x for x in (body, rest - body) if x]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, grain: int = GRAIN, remembered: int = REMEMBERED) -> DataFrame:
    """The pieces of all documents, each with its place (nth) among its length in its part."""
    batches(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        end = np.array([END_ID], "<u4").tobytes()
        for b in sliced(parts):
            rows = []
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), encoder(path).encode_batch(b.column("text").to_pylist(), remembered)):
                ids, at = memoryview(ids + end), 0
                total = len(ids) // 4
                for n in cuts(total, capacity, grain):
                    seen[n] = seen.get(n, -1) + 1
                    rows.append((doc_id, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), total, part, seen[n]))
                    at += n
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [x.split(" ")[0] for x in PIECES.split(", ")])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, PIECES)


def best_column(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: the dearest multiset of lengths within the capacity."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = np.flatnonzero(lengths <= c)
        if len(fits):
            got = prices[fits] + value[c - lengths[fits]]
            k = int(got.argmax())
            if got[k] > value[c - 1] + 1e-12:
                value[c], choice[c] = got[k], fits[k]
                continue
        value[c] = value[c - 1]
    column, c = np.zeros(len(lengths)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            column[choice[c]] += 1
            c -= lengths[choice[c]]
    return float(value[capacity]), column


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY, rounds: int = 2000) -> list[tuple[int, np.ndarray]]:
    """Patterns and how often to use each, rounded down so that no count is exceeded.

    Column generation over the linear program: least sequences with every length's count covered;
    the basis starts with one pattern for each length.
    """
    m = len(lengths)
    basis = np.diag((capacity // lengths).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    x = inverse @ counts
    for k in range(rounds):
        prices = np.maximum(inverse.sum(axis=0), 0)
        value, column = best_column(lengths, prices, capacity)
        if value <= 1 + 1e-9:
            break
        step = inverse @ column
        up = np.flatnonzero(step > 1e-10)
        ratios = x[up] / step[up]
        out = int(up[ratios.argmin()])
        theta = x[out] / step[out]
        x = np.maximum(x - theta * step, 0)
        x[out] = theta
        basis[:, out] = column
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        if k % 100 == 99:
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ counts, 0)
    left, plan = counts.astype(np.int64).copy(), []
    for j in np.argsort(-x, kind="stable"):
        column = basis[:, j].astype(np.int64)
        held = column > 0
        times = min(int(x[j] + 1e-6), int((left[held] // column[held]).min()))
        if times > 0:
            plan.append((times, column))
            left -= times * column
    return plan


def runs(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """The assignment: (length, first rank, ranks, first sequence, pieces of the length in a
    sequence, first offset).  Rank r of a run goes to sequence first + (r - first rank) // pieces,
    at first offset + length * ((r - first rank) % pieces)."""
    out, sequence = [], 0
    if capacity in histogram:
        out.append((capacity, 0, histogram[capacity], 0, 1, 0))
        sequence = histogram[capacity]
    lengths = np.array(sorted((n for n in histogram if n != capacity), reverse=True), np.int64)
    if not len(lengths):
        return out
    counts = np.array([histogram[n] for n in lengths], float)
    rank = np.zeros(len(lengths), np.int64)
    for times, column in solve(lengths, counts, capacity):
        offset = 0
        for i in np.flatnonzero(column):
            k = int(column[i])
            out.append((int(lengths[i]), int(rank[i]), times * k, sequence, k, offset))
            rank[i] += times * k
            offset += k * int(lengths[i])
        sequence += times
    room: list[int] = []
    for i, n in enumerate(lengths):  # first fit decreasing: at most some patterns' worth of pieces
        for r in range(int(rank[i]), int(counts[i])):
            k = next((j for j, free in enumerate(room) if free >= n), len(room))
            if k == len(room):
                room.append(capacity)
            out.append((int(n), r, 1, sequence + k, 1, capacity - room[k]))
            room[k] -= int(n)
    return out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, grain: int = GRAIN, remembered: int = REMEMBERED) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    ``remembered`` chunks a worker at most: memory against time, whatever it is the rows are the same.

    A null or empty text is its end id alone.  Repeated rows are packed each by itself.
    """
    spark = docs.sparkSession
    rows = publish(pieces(docs, path, capacity, grain, remembered), "pieces")
    held = publish(rows.groupBy("length", "part").agg(F.count("*").alias("held")), "held")
    before = F.sum("held").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = held.select(F.col("length").alias("__length"), F.col("part").alias("__part"), F.coalesce(before, F.lit(0)).alias("before"))
    histogram = {r[0]: r[1] for r in held.groupBy("length").agg(F.sum("held")).collect()}
    assigned = spark.createDataFrame(runs(histogram, capacity), "length long, first long, ranks long, sequence long, each long, at long")
    ranked = rows.join(F.broadcast(base) if held.count() <= 250_000 else base, (F.col("length") == F.col("__length")) & (F.col("part") == F.col("__part"))).withColumn("rank", F.col("before") + F.col("nth"))
    on = (ranked["length"] == assigned["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("ranks"))
    nth = F.col("rank") - F.col("first")
    return ranked.join(F.broadcast(assigned), on).select(
        "doc_id", "start", ranked["length"], "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + ranked["length"] * (nth % F.col("each"))).cast("long").alias("offset"),
    )
