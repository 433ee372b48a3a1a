"""Text normalisation as Column expressions (Unicode-aware: every pattern has ``(?U)``).

Rule tables are lists of (label, patterns) in order of priority; they come from YAML
(``talus.sources.config``) or from ``talus.functions.rules``.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters whose decomposition ends in marks alone: U+00C0 to U+024F and U+1E00 to U+1EFF.
RANGES = ((0xC0, 0x250), (0x1E00, 0x1F00))


@lru_cache(maxsize=1)
def accents() -> tuple[str, str]:
    """Accented letters and their bases, generated from Unicode decompositions."""
    rows = []
    for lo, hi in RANGES:
        for c in map(chr, range(lo, hi)):
            base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
            if len(base) == 1 and base != c:
                rows.append((c, base))
    return "".join(r[0] for r in rows), "".join(r[1] for r in rows)


def java(literal: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}\-])", r"\\\1", literal)


def norm(c: Column) -> Column:
    """Lower case, white space (any Unicode) collapsed and trimmed; null becomes empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")))


def strip_accents(c: Column, fold_dstroke: bool = False) -> Column:
    """Accents go by canonical decomposition; the stroked d stays unless asked for."""
    out = F.regexp_replace(F.translate(c, *accents()), r"\p{Mn}", "")
    return F.translate(out, "đĐ", "dD") if fold_dstroke else out


def contains_word(c: Column, literal: str) -> Column:
    return c.rlike(r"(?U)(?<!\w)" + java(literal) + r"(?!\w)")


def first_rule(hay: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The label of the first rule of which any pattern, normalised as the text is, occurs as whole words."""
    out = F.lit(default)
    for label, patterns in reversed(rules):
        plain = [x for p in patterns if (x := " ".join(p.lower().split()))]
        if not plain:
            continue
        any_ = r"(?U)(?<!\w)(?:" + "|".join(map(java, plain)) + r")(?!\w)"
        out = F.when(hay.rlike(any_), label).otherwise(out)
    return out


def longest_alias(hay: Column, aliases: list[tuple[str, str]], single: set[str] = frozenset()) -> Column:
    """(code, alias) of the longest alias found; one-word aliases count only if whitelisted; ties:
    first of the table.  One CASE in order of length, no join."""
    usable = [(i, code, a) for i, (code, a) in enumerate(aliases) if " " in a or a in single]
    out = F.lit(None).cast("struct<code:string,alias:string>")
    for _, code, a in sorted(usable, key=lambda x: (len(x[2]), -x[0])):
        out = F.when(contains_word(hay, a), F.struct(F.lit(code).alias("code"), F.lit(a).alias("alias"))).otherwise(out)
    return out


def rule_norm(c: Column) -> Column:
    return norm(F.regexp_replace(F.coalesce(c, F.lit("")), r"[_\-/]+", " "))


def extract_terms(tags: Column, text: Column, aliases: dict[str, str], least: int = 3) -> tuple[Column, Column]:
    """Sorted canonical terms of tags (any alias) and text (aliases of ``least`` letters on, longest
    first, not inside ASCII words), and the tags, as they stand, that no alias maps."""
    table = F.create_map(*[F.lit(x) for kv in sorted(aliases.items()) for x in kv])
    names = sorted((a for a in aliases if len(a) >= least), key=lambda a: (-len(a), a))
    pattern = "(?<![a-z0-9])(" + "|".join(map(java, names)) + ")(?![a-z0-9])"
    raw = F.coalesce(tags, F.array().cast("array<string>"))
    clean = F.filter(F.transform(raw, norm), lambda t: t != "")
    hits = F.regexp_extract_all(norm(text), F.lit(pattern), F.lit(1))
    found = F.filter(F.transform(F.concat(clean, hits), lambda t: F.try_element_at(table, t)), lambda t: t.isNotNull())
    return F.array_sort(F.array_distinct(found)), F.filter(raw, lambda t: (norm(t) != "") & ~F.map_contains_key(table, norm(t)))


def first_place(hay: Column, places: list[tuple[str, str, list[str]]]) -> Column:
    """(place, region) of the pattern that begins first; ties: first of the table; none: null."""
    spots = []
    for order, (place, region, patterns) in enumerate(places):
        for p in patterns:
            at = F.instr(hay, p)
            spots.append(F.when(at > 0, F.struct(at.alias("at"), F.lit(order).alias("order"), F.lit(place).alias("place"), F.lit(region).alias("region"))))
    best = F.array_min(F.array_compact(F.array(*spots)))
    return F.struct(best["place"].alias("place"), best["region"].alias("region"))


def any_of(hay: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(hay, F.lit(w))
    return out


def codes_of(hay: Column, table: list[tuple[str, list[str]]]) -> Column:
    """Codes of which any keyword is a substring, in the table's order."""
    return F.array_compact(F.array(*[F.when(any_of(hay, words), F.lit(code)) for code, words in table]))


def clean_company(c: Column, tokens: list[str]) -> Column:
    """Legal and geographic tokens go, edges are trimmed; empty becomes null."""
    s = F.regexp_replace(norm(c), r"(?iU)\b(?:" + "|".join(tokens) + r")\b", " ")
    s = F.regexp_replace(s, r"(?U)\s+", " ")
    return F.nullif(F.btrim(s, F.lit(" .,-")), F.lit(""))


def clean_title(c: Column) -> Column:
    """Bracketed spans go; if nothing is left, the trimmed title; a blank one is null."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(c, r"[\(\[\{].*?[\)\]\}]", " "), r"(?U)\s+", " "))
    return F.coalesce(F.nullif(bare, F.lit("")), F.nullif(F.trim(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), F.lit("")))


def letter_ratio(c: Column, letters: str, places: int = 4, marked: bool = False) -> Column:
    """Share of the given letters (``marked``: and of all accented ones) among all letters (0 without letters)."""
    letters += accents()[0].lower() if marked else ""
    low = F.lower(F.coalesce(c, F.lit("")))
    n = F.length(F.regexp_replace(low, r"\P{L}", ""))
    hit = F.length(F.regexp_replace(low, f"[^{letters}]", ""))
    return F.when(n > 0, F.round(hit / n, places)).otherwise(F.lit(0.0))


def view(title: Column, items: Column, body: Column, drop: str, cap: int = 4000) -> Column:
    """Title, listed items and the first ``cap`` characters of the body's lines without blank and
    boilerplate ones, white space collapsed."""
    flat = lambda x: F.trim(F.regexp_replace(x, r"(?U)[\s\x1c-\x1f]+", " "))
    lines = F.filter(F.split(F.coalesce(body, F.lit("")), "\\R|[\\x1c-\\x1e]"), lambda x: (flat(x) != "") & ~F.lower(x).rlike(drop))
    kept = F.substring(flat(F.concat_ws(" ", lines)), 1, cap)
    listed = F.when(F.size(items) > 0, F.concat(F.lit("Skills: "), F.concat_ws(", ", items)))
    return flat(F.concat_ws(" \n", title, listed, kept))


def content_hash(*parts: Column) -> Column:
    """The first 16 hex digits of sha256 over each part and a zero byte."""
    end = F.decode(F.unhex(F.lit("00")), "UTF-8")
    return F.substring(F.sha2(F.concat(*[x for p in parts for x in (F.coalesce(p, F.lit("")), end)]), 256), 1, 16)


def html_text(c: Column) -> Column:
    """Text of markup: scripts, styles, comments and tags become spaces, common references are decoded."""
    s = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    for ref, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(ref), F.lit(char))
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def tokens(c: Column, stop: list[str], letters: str = r"[\p{IsLatin}]+") -> Column:
    """Lower-cased words of more than one letter that are no stop words."""
    words = F.regexp_extract_all(F.lower(c), F.lit(f"({letters})"), F.lit(1))
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(stop)) if stop else F.filter(words, lambda w: F.length(w) > 1)


def coerce_code(c: Column, names: dict[str, str]) -> Column:
    """A known code (upper case, underscores) or the code of a known name; else null."""
    code = F.replace(F.upper(F.trim(c)), F.lit(" "), F.lit("_"))
    by_name = F.create_map(*[F.lit(x) for k, v in sorted(names.items()) for x in (k.lower(), v)])
    return F.when(code.isin(sorted(set(names.values()))), code).otherwise(F.try_element_at(by_name, F.lower(F.trim(c))))
