"""Secret scan by a trigram inverted index (native: DataFrame functions only).

Each rule is a regular expression; its Boolean trigram query is derived from the expression
(``trigrams``).  The index maps (trigram, segment) to a posting list of document ids,
for the trigrams that the rules ask for; lists are intersected and united as the queries say, segment
by segment, and the surviving documents alone are verified with the expression.
A rule without mandatory trigrams verifies every document.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.llm.common import packed, publish, small, text_of, unpacked
from talus.llm.trigrams import Query, query_of, trigrams

#: Ids of one segment: the longest posting list.
SEGMENT = 2048
WORKING = "`__mask`"
#: Elements of a block of running sums, code points of a block of text.
BLOCK, TEXT_BLOCK = 64, 1024


@dataclass(frozen=True)
class Rule:
    """A match counts if its group ``group`` (0: all) has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    def query(self) -> Query:
        """The trigram query of the pattern; None: scan fully."""
        return _query(self.pattern)


@lru_cache(maxsize=1024)
def _query(pattern: str) -> Query:
    return query_of(pattern)


# Fixed values of the contract: the three base rules.  A run of hex digits is maximal, so its
# least length stands in the expression itself.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds that the method finds beside the base ones.
EXTRA = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + EXTRA


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index (segment, trigram, ids): ids sorted, distinct and at most SEGMENT."""
    # the text is lower-cased once: named outright, it would be again for each trigram
    held = lambda low: F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in sorted({t for r in rules for t in trigrams(r.query())})]))
    return (
        docs.where(F.col("doc_id").isNotNull())
        .select("doc_id", F.explode(F.transform(F.array(F.lower(text_of())), held)[0]).alias("trigram"))
        .groupBy(F.expr(f"floor(doc_id / {SEGMENT})").alias("segment"), "trigram")
        .agg(F.array_sort(F.collect_set("doc_id")).alias("ids"))
    )


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, mask): bit i of mask is set if rule i's trigram query holds for the document."""
    lists = index.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def of(query: Query) -> Column:
        if isinstance(query, str):
            return F.coalesce(F.try_element_at("lists", F.lit(query)), none)
        return reduce(F.array_intersect if query[0] == "and" else F.array_union, map(of, query[1]))

    asked = [(i, r) for i, r in enumerate(rules) if r.query() is not None]
    return (
        lists.select(F.explode(F.array(*[F.struct(F.lit(1 << i).alias("bit"), of(r.query()).alias("ids")) for i, r in asked])).alias("q"))
        .select(F.explode("q.ids").alias("doc_id"), F.col("q.bit").alias("bit"))
        .groupBy("doc_id")
        .agg(F.bit_or("bit").alias("__mask"))
    )


def _bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, op=lambda a, b: a + b) -> Column:
    """What ``op`` makes of all elements before each (0 before the first), of an array of numbers from 0 on.

    Blocks of blocks are folded first: the time is linear in the length, but for arrays far beyond
    BLOCK**3 elements.
    """
    fold = lambda x: F.aggregate(x, F.lit(0), op)
    before = lambda x: F.transform(x, lambda _, i: fold(F.slice(x, F.lit(1), i)))
    blocks = lambda x: F.transform(F.sequence(F.lit(0), F.greatest(F.size(x) - 1, F.lit(0)), F.lit(BLOCK)), lambda i: F.slice(x, i + 1, F.lit(BLOCK)))

    def of(x: Column, depth: int) -> Column:
        if depth == 0:
            return before(x)
        return _bound(blocks(x), lambda b: F.flatten(F.zip_with(b, _bound(F.transform(b, fold), lambda s: of(s, depth - 1)), lambda part, start: F.transform(before(part), lambda y: op(y, start)))))

    return _bound(values, lambda x: of(x, 2))


def _spans(rule: Rule, raw: str) -> Column:
    """Spans of one rule from its raw pieces: code point offsets, end exclusive."""
    m = F.col(raw)
    # before hit i stand i + 1 gaps and i hits
    steps = F.zip_with(m["hits"], F.slice(m["gaps"], F.lit(2), F.size(m["hits"])), lambda h, g: F.length(h) + F.length(g))
    starts = F.transform(running(steps), lambda x: x + F.length(F.get(m["gaps"], F.lit(0))))
    found = F.transform(F.arrays_zip(starts.alias("start"), m["hits"].alias("hit"), m["vals"].alias("val")), lambda x: F.struct(x["start"].alias("start"), x["hit"].alias("hit"), F.length(x["val"]).alias("n")))
    kept = F.transform(
        F.filter(found, lambda s: s["n"] >= rule.least),
        lambda s: F.struct(s["start"].alias("start"), (s["start"] + F.length(s["hit"])).alias("end"), F.lit(rule.kind).alias("kind")),
    )
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return F.when(F.coalesce(F.size(m["hits"]), F.lit(0)) > 0, kept).otherwise(empty)


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row with its spans: ``doc_id, text`` (null: empty), ``keep`` and ``found``.

    ``found`` holds an array of (start, end, kind) for each rule's kind, in a struct.
    Rows with a null id are no part of the index: every rule verifies them.  Repeated
    ids share one posting; each of their rows is verified by itself.
    """
    index = postings(docs.select("doc_id", "text"), rules)
    hit = small(publish(candidates(index, rules), "secret_candidates"))
    rows = docs.select("doc_id", text_of().alias("text"), *keep).join(hit, "doc_id", "left")
    every = sum(1 << i for i, r in enumerate(rules) if r.query() is None)
    mask = F.when(F.col("doc_id").isNull(), F.lit((1 << len(rules)) - 1)).otherwise(
        F.coalesce(F.col(WORKING), F.lit(0)).bitwiseOR(F.lit(every))
    )
    rows = rows.withColumn("__mask", mask)
    raw = {}
    for i, r in enumerate(rules):
        one = F.struct(
            F.split("text", r.pattern, -1).alias("gaps"),
            F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)).alias("hits"),
            F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group)).alias("vals"),
        )
        asked = (F.col(WORKING).bitwiseAND(F.lit(1 << i)) != 0) & F.rlike("text", F.lit(r.pattern))
        raw[f"__raw_{r.kind}"] = F.when(asked, one)
    rows = rows.withColumns(raw)
    found = F.struct(*[_spans(r, f"__raw_{r.kind}").alias(r.kind) for r in rules])
    return rows.select("doc_id", "text", *keep, found.alias("found"))


def joined(found: str, rules: tuple[Rule, ...], order: tuple[str, ...] = tuple(r.kind for r in RULES)) -> Column:
    """``kind:start:end`` of all spans by start, then by the kind's place, comma-joined."""
    rank = F.create_map(*[x for i, k in enumerate(order) for x in (F.lit(k), F.lit(i))])
    spans = F.flatten(F.array(*[F.col(f"{found}.{r.kind}") for r in rules]))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """The digest of the scan, a row for each document row (empty text: zero counts)."""
    rows = find(docs).withColumn("base", joined("found", BASE))
    n = lambda kind: F.size(F.col(f"found.{kind}")).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id", n("assign"), n("access"), n("hex"),
        F.sha2("base", 256).alias("base_sha256"), joined("found", RULES).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span's text replaced by ``mark``; overlapping spans become one.

    Null and empty texts stay as they are, repeated rows and null ids are treated like any other,
    and an empty table stays empty.  The time is linear in the length of a text and in its spans.
    """
    rows = find(docs.select("doc_id", "text", packed(docs).alias("row")), keep=("row",))
    spans = F.array_sort(F.flatten(F.array(*[F.col(f"found.{r.kind}") for r in RULES])))

    def cut(text: Column) -> Column:
        """(start, end) -> that part of a text known by its blocks."""
        return lambda a, b: F.substring(F.array_join(F.slice(text, F.floor(a / TEXT_BLOCK).cast("int") + 1, F.floor(b / TEXT_BLOCK).cast("int") - F.floor(a / TEXT_BLOCK).cast("int") + 1), ""), (a % TEXT_BLOCK).cast("int") + 1, b - a)

    def clean(s: Column, text: Column) -> Column:
        done = running(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b))  # where the spans before end
        piece = lambda x, at: F.when(x["start"] >= at, F.concat(cut(text)(at, x["start"]), F.lit(mark))).otherwise("")
        end = F.array_max(F.transform(s, lambda x: x["end"]))
        return F.concat(F.array_join(F.zip_with(s, done, piece), ""), cut(text)(end, F.length("text")))

    blocks = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))
    done = F.when(F.size(spans) > 0, _bound(spans, lambda s: _bound(blocks, lambda t: clean(s, t)))).otherwise(F.col("row.text"))
    return unpacked(rows, docs.columns, text=done)
