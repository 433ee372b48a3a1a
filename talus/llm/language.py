"""Language ID by bit-sliced Bloom filters over character n-grams.

Slot ``b`` of the filter holds one bit for each language, in as many 64-bit words as that takes:
the slices of all languages side by side.  An n-gram's slots (one for each hash) combined by AND give all languages
that contain it at once.  Over a text, the bits are counted for each language; a count
is corrected by the rate at which that language's slice says yes to a foreign n-gram;
the highest corrected share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm.common import batches, column, packed, power_of_two, sliced, unpacked

SIZES = (1, 2, 3, 4)
HASHES = 3
#: Slots of the filter for each n-gram of the language that has most.
SLOTS = 12
#: The model is fitted on about so many labelled rows of a language at most (by a hash of the id).
FIT_ROWS = 1500
#: Of a language the filter holds the n-grams that at least this share of those rows have.
FIT_SHARE = 0.02
#: A filtering stage keeps texts from this score on.
KEEP_SCORE = 0.2
_PRIMES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Model:
    """``words``: the bit-sliced filter (slots, words of a slot); ``wrong``: for each language the rate of false positives."""

    languages: tuple[str, ...]
    words: np.ndarray
    wrong: np.ndarray


def codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text; all but letters become one space, runs of it too."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(x):
        return x.astype(np.uint64)
    letter = ((x >= 97) & (x <= 122)) | (x == 0xAA) | (x == 0xB5) | (x == 0xBA) | ((x >= 0xC0) & (x != 0xD7) & (x != 0xF7))
    odd = np.flatnonzero(letter & (x >= 0x2B0))
    if len(odd):
        values, back = np.unique(x[odd], return_inverse=True)
        letter[odd] = np.array([chr(v).isalpha() for v in values])[back]
    y = np.where(letter, x, 32).astype(np.uint64)
    keep = np.ones(len(y), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1]
    y = y[keep]
    return np.concatenate((np.array([32], np.uint64), y, np.array([32], np.uint64))) if letter.any() else y[:0]


def grams(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of the n-grams of all sizes, repeats included, without lone spaces."""
    out, h = [], np.zeros(len(x), np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(x) < n:
            break
        h = (h[: len(x) - n + 1] ^ x[n - 1 :]) * _PRIMES[(n - 1) % 4]
        h ^= h >> np.uint64(29)
        if n in SIZES:
            out.append(h[x != 32] if n == 1 else h)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _spots(h: np.ndarray, i: int, slots: int) -> np.ndarray:
    y = (h ^ (h >> np.uint64(31))) * _PRIMES[i]
    return ((y >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)


def is_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 != 2


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on labelled rows that are not held out: about ``fit_rows`` of a language at most, by
    a hash of the id, their whole texts.

    The n-grams that the filter holds reach the driver: of a language at most 1 / FIT_SHARE times
    the distinct n-grams of an average text, however many rows the corpus has.
    """
    batches(docs.sparkSession)
    train = docs.where(F.col("lang").isNotNull() & F.coalesce(is_training(F.col("doc_id")), F.lit(False)) & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    names = tuple(sorted(sizes))
    if not names:
        return build({})
    share = F.create_map(*[x for k in names for x in (F.lit(k), F.lit(min(1.0, fit_rows / sizes[k])))])
    draw = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1_000_000)) / 1_000_000.0
    sample = train.where(draw < share[F.col("lang")]).select("lang", "text")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(parts):
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                by.setdefault(lang, []).append(np.unique(grams(codes(text))))
            for lang, found in by.items():
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(h), pa.string()), "gram": pa.array(h.view(np.int64)), "n": pa.array(n, pa.int64())})

    rows = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    least = F.create_map(*[x for k in names for x in (F.lit(k), F.lit(max(2.0 if rows.get(k, 0) > 20 else 1.0, FIT_SHARE * rows.get(k, 0))))])
    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") >= least[F.col("lang")]).select("lang", "gram").toArrow()
    lang, gram = found.column("lang").to_numpy(), found.column("gram").to_numpy().view(np.uint64)
    return build({k: gram[lang == k] for k in names})


def build(learned: dict[str, np.ndarray]) -> Model:
    """The model that holds each language's n-gram hashes; sized by the language that has most."""
    names = tuple(sorted(learned))
    slots = power_of_two(SLOTS * max([1, *map(len, learned.values())]))
    words, fill = np.zeros((slots, max(1, -(-len(names) // 64))), np.uint64), np.zeros(len(names))
    for i, lang in enumerate(names):
        slice_, bit = words[:, i // 64], np.uint64(1) << np.uint64(i % 64)
        for k in range(HASHES):
            np.bitwise_or.at(slice_, _spots(learned[lang], k, slots), bit)
        fill[i] = float(((slice_ & bit) != 0).mean())
    return Model(names, words, fill**HASHES)


def counts(h: np.ndarray, model: Model) -> np.ndarray:
    """For each language how many of the n-gram hashes its slice says that it contains."""
    said = reduce(np.bitwise_and, (model.words[_spots(h, i, len(model.words))] for i in range(HASHES)))
    return np.array([np.count_nonzero(said[:, i // 64] & (np.uint64(1) << np.uint64(i % 64))) for i in range(len(model.languages))], float)


def shares(text: str, model: Model) -> np.ndarray:
    """For each language the corrected share of the text's n-grams that it contains (0 to 1)."""
    h = grams(codes(text))
    if not len(h):
        return np.zeros(len(model.languages))
    return np.clip((counts(h, model) / len(h) - model.wrong) / (1 - model.wrong), 0, 1)


def decide(text: str | None, model: Model) -> tuple[str, float]:
    """The language of the highest share (ties: first by name) and that share, to 6 places.

    ``und`` and 0 for a null text or one without letters, or if no language was learned.
    """
    if text is None or not model.languages or not any(c.isalpha() for c in text):
        return "und", 0.0
    s = shares(text, model)
    best = int(s.argmax())
    return model.languages[best], round(float(s[best]), 6)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = (), text: str = "text") -> DataFrame:
    """``keep`` columns and lang_pred, score for every row, of the text alone (``text``: its column, or
    ``row.text`` for the field of a kept column)."""
    batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep) if "." in text else docs.select(*keep, F.col(text).alias("__text"))
    path = text if "." in text else "__text"
    schema = T.StructType([kept.schema[c] for c in keep]).add("lang_pred", "string").add("score", "double")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(parts, path):
            found = [decide(t, shared.value) for t in column(b, path).to_pylist()]
            cols = [b.column(c) for c in keep] + [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, [*keep, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """A row for each document row: doc_id, held_out, lang_pred, score.

    A row with a null id is neither learned from nor held out.
    """
    out = predict(docs, model or fit(docs), ("doc_id",))
    held = F.coalesce(~is_training(F.col("doc_id")), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, model: Model | None = None, least: float = KEEP_SCORE) -> DataFrame:
    """``docs`` whose text has a language: not ``und``, and a score of ``least`` or more.

    Null texts and those without letters go; repeated rows and null ids are judged like any other;
    an empty table stays empty.
    """
    found = predict(docs.select(packed(docs).alias("row")), model or fit(docs), ("row",), "row.text")
    return unpacked(found.where((F.col("lang_pred") != "und") & (F.col("score") >= least)), docs.columns)
