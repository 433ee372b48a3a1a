"""The operators as queries over the whole tables, and their SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talus.llm import bpe, exact, html, language, licenses, packing, prefix, secrets, simhash, urls

#: Folder of the vocabulary files; None: the installed package of public tokenizers.
TOKENIZERS: str | None = None


def vocabulary(name: str) -> str:
    if TOKENIZERS is not None:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def queries() -> dict:
    docs = lambda s, d: _read(s, d, "documents")
    pages = lambda s, d: _read(s, d, "pages")
    return {
        "op1_secret_scan": lambda s, d: secrets.scan(docs(s, d)),
        "op2_html_extraction": lambda s, d: html.extract(pages(s, d)),
        "op3_url_filter": lambda s, d: urls.judge(pages(s, d)),
        "op4_license_scan": lambda s, d: licenses.scan(docs(s, d)),
        "op5_packing": lambda s, d: packing.pack(docs(s, d), vocabulary("byte_bpe_50k.json")),
        "op6_exact_dedup": lambda s, d: exact.dedup(docs(s, d)).drop("rid"),
        "op7_language_id": lambda s, d: language.identify(docs(s, d)),
        "op8_simhash_near_dedup": lambda s, d: simhash.near_copies(docs(s, d)),
        "op9_document_fingerprint": lambda s, d: prefix.fingerprints(docs(s, d)),
        "op10_bpe_round_trip": lambda s, d: bpe.digest(docs(s, d), vocabulary("word_bpe_49k.json")),
    }


def _secret_sql() -> str:
    kinds = (
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
    )
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(kinds):
        p = quote(pattern)
        parts.append(f"""
  SELECT rid, '{kind}' AS kind, {rank} AS rank, s AS start, s + length(hit) AS stop FROM (
    SELECT rid, unnest(hits) AS hit, unnest(vals) AS val, unnest(starts) AS s FROM (
      SELECT rid, hits, vals, list_transform(range(1, len(hits) + 1),
             lambda i: coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0)::BIGINT) AS starts
      FROM (SELECT rid, regexp_extract_all(t, {p}, 0) AS hits, regexp_extract_all(t, {p}, {group}) AS vals, string_split_regex(t, {p}) AS gaps FROM d)
      WHERE len(hits) > 0)) WHERE length(val) >= {least}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(parts)}),
said AS (SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS c, count(*) FILTER (WHERE kind = 'hex') AS h,
                string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS found FROM spans GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(found, '')) AS base_sha256,
       coalesce(found, '') AS spans
FROM d LEFT JOIN said USING (rid)"""


def _license_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(n, " ".join(licenses.words_of(t))) for n, t in licenses.TEMPLATES)
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH t AS (SELECT license, {grams} AS b FROM (SELECT license, string_split(words, ' ') AS w FROM (VALUES {rows}) AS v(license, words))),
-- a sentence mark before blanks ends a unit; the mark itself is no word, so it may go
units AS (SELECT doc_id, unnest(string_split_regex(coalesce(text, ''), '[.!?;][ \\t]+|[\\r\\n]+')) AS u FROM documents),
u AS (SELECT doc_id, row_number() OVER () AS uid, {grams} AS g FROM (
        SELECT doc_id, string_split(trim(regexp_replace(lower(u), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM units) WHERE len(w) >= 2),
hit AS (SELECT doc_id, uid, license, 2.0::DOUBLE * len(list_intersect(g, b)) / (len(g) + len(b)) AS dice FROM u, t WHERE len(g) BETWEEN 0.6 * len(b) AND 1.6 * len(b)),
best AS (SELECT doc_id, uid, arg_min(license, (-dice, license)) AS license, max(dice) AS dice FROM hit WHERE dice >= {licenses.THRESHOLD} GROUP BY doc_id, uid)
SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) AS n_notices, round(max(dice), 4) AS best_dice FROM best GROUP BY doc_id"""


def oracle_sql() -> dict[str, str]:
    """op6's SQL compares normalised texts themselves; the methods of the operators left out
    (trained models, fingerprints, tokenizers, packing) are held against brute force in the tests."""
    return {
        "op1_secret_scan": _secret_sql(),
        "op4_license_scan": _license_sql(),
        "op6_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t, row_number() OVER () AS rid FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, rid) = 1 AS kept, sha256(t) AS text_sha256 FROM d""",
    }
