"""One registered query per training-data operator, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm import bpe, bytebpe, fingerprint, html, langid, lm, packing, periodic, pii, pivots, quality, suffix, superminhash
from lakeshift.llm.common import documents, ship_package


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(documents(spark, sf_dir), k=3, percent=85)


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(documents(spark, sf_dir))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_features(documents(spark, sf_dir)).drop("rejected_by")


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pivots.codes_with_errors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(documents(spark, sf_dir))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.encode_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_packing": op2_packing,
    "op3_langid": op3_langid,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_html": op5_html,
    "op6_fingerprint": op6_fingerprint,
    "op7_pii": op7_pii,
    "op8_repeats": op8_repeats,
    "op9_quality_rules": op9_quality_rules,
    "op10_lm": op10_lm,
    "op11_vector_codes": op11_vector_codes,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_byte_bpe": op13_byte_bpe,
}

#: DuckDB forms. ``WORDS`` is the list of words of a text.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, {_WORDS} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), g AS (
  SELECT k, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM d
), s AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g
), c AS (
  SELECT k, count(DISTINCT p) AS n_repeat FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM s WHERE n > 1) GROUP BY k
), f AS (
  SELECT d.doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
    len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
    len(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_upper, len(regexp_replace(t, '\P{{L}}+', '', 'g')) AS n_letters
  FROM d LEFT JOIN c USING (k)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 40 * n_lines
    OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 2 * n_upper > n_letters) AS kept
FROM b
"""

#: Links by counting common shingles of all pairs that share any, then what is reachable.
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS shingle
  FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), together AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), half AS (
  SELECT a, b FROM together JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), link AS (
  SELECT a, b FROM half UNION ALL SELECT b, a FROM half
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT doc_id, b FROM reach JOIN link ON other = a
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN least USING (doc_id)
"""

#: Every window of 100 hexadecimal digits, the least document of those that repeat, and the stretches they cover.
REPEATS_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS i, h FROM d
), x AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM w
), r AS (
  SELECT s, min(doc_id) AS first FROM x GROUP BY s HAVING min(doc_id) < max(doc_id)
), g AS (
  SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM x JOIN r USING (s) WHERE first < doc_id
), m AS (
  SELECT doc_id, i, step, count(*) FILTER (step IS NULL OR step > 50) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g
), spans AS (
  SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b, sum(least(coalesce(step, 50), 50)) AS n FROM m GROUP BY ALL
), pieces AS (
  SELECT doc_id, a, n, h[2 * coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1:2 * a] AS piece,
    h[2 * b + 1:] AS tail, b = max(b) OVER (PARTITION BY doc_id) AS last FROM spans JOIN d USING (doc_id)
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b_minus_a) AS n_removed, string_agg(piece || CASE WHEN last THEN tail ELSE '' END, '' ORDER BY a) AS kept
  FROM (SELECT p.*, s.b - s.a AS b_minus_a FROM pieces p JOIN spans s USING (doc_id, a)) GROUP BY doc_id
)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""



def vector_codes_sql(parts: int = pivots.PARTS, entries: int = pivots.ENTRIES, rounds: int = pivots.ROUNDS, scale: int = pivots.SCALE) -> str:
    """Every part against every entry, round by round."""
    out = [
        f"""whole AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS k, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
  SELECT k, m, v[1 + m * (len(v) // {parts}):(m + 1) * (len(v) // {parts})] AS x FROM whole, range({parts}) AS p(m)
), book0 AS MATERIALIZED (
  SELECT m, k - 1 AS e, x AS c FROM part WHERE k <= {entries}
)"""
    ]
    for r in range(rounds + 1):
        out.append(
            f"""near{r} AS MATERIALIZED (
  SELECT k, m, min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) AS best
  FROM part JOIN book{r} USING (m) GROUP BY k, m
)"""
        )
        if r < rounds:
            out.append(
                f"""mean{r} AS MATERIALIZED (
  SELECT m, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c FROM (
    SELECT m, best.e AS e, i, count(*) AS n, sum(x[i]) AS s FROM part JOIN near{r} USING (k, m), range(1, len(x) + 1) AS p(i) GROUP BY ALL
  ) GROUP BY m, e
), book{r + 1} AS MATERIALIZED (
  SELECT m, e, coalesce(n.c, o.c) AS c FROM book{r} o LEFT JOIN mean{r} n USING (m, e)
)"""
            )
    return f"""WITH {", ".join(out)}, coded AS (
  SELECT k, string_agg(printf('%02x', best.e), '' ORDER BY m) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY k
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY m, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN whole USING (k), digest"""


ORACLE_SQL: dict[str, str] = {
    "op4_near_duplicates": NEAR_DUPLICATES_SQL,
    "op11_vector_codes": vector_codes_sql(),
    "op8_repeats": REPEATS_SQL,
    "op9_quality_rules": QUALITY_SQL,
}
