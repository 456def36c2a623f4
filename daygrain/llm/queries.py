"""Queries that apply each operator to its whole table; ``sf`` names the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from daygrain.llm import alignment, decontaminate, language, lattice, licenses, minhash, packing, repeats, secrets, token_files, vectors, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, if its result can be written in SQL, that SQL."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_near_duplicates")
def op1(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"), k=4, percent=80)


def vocabulary(name: str) -> str:
    """Where the installed public tokenizers keep a vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_best_fit_packing")
def op2(spark, sf):
    return packing.pack(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), capacity=4096)


@query("op3_language_id")
def op3(spark, sf):
    return language.languages(table(spark, sf, "documents"))


@query("op4_vector_near_duplicates")
def op4(spark, sf):
    return vectors.near_vectors(table(spark, sf, "embeddings"), cosine=0.98)


@query("op5_benchmark_decontamination")
def op5(spark, sf):
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


@query("op7_suffix_dedup")
def op7(spark, sf):
    return repeats.repeats(table(spark, sf, "documents"), length=400).drop("spans")


@query("op10_lattice_likelihood")
def op10(spark, sf):
    return lattice.document_scores(table(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op11_token_files")
def op11(spark, sf):
    return token_files.round_trip(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), end=2)


@query("op12_token_alignment")
def op12(spark, sf):
    return alignment.aligned(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query("op13_embedding_whitening")
def op13(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def _found_sql(no: int, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, {no} AS no, m, g, generate_subscripts(m, 1) AS i FROM (
      SELECT doc_id, regexp_extract_all(t, '{quoted}') AS m, regexp_split_to_array(t, '{quoted}') AS g FROM d)"""


_KEEP_SQL = {
    "assign": "length(regexp_extract(m, '{p}', 2)) >= 8", "access": "length(m) >= 16", "hex": "true",
    "ident": "length(regexp_extract(m, '{p}', 2)) >= 3",
    "key": "regexp_full_match(m, '[A-Za-z0-9+/]{{40}}') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')",
    "endpoint": "true",
}
_NEAR = f"r.doc_id = l.doc_id AND r.s <= l.e + {secrets.SCOPE} AND l.s <= r.e + {secrets.SCOPE}"
OP9_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(_found_sql(i, k.pattern) for i, k in enumerate(secrets.KINDS))}),
each AS (SELECT doc_id, no, m[i] AS m, i, length(g[i]) + length(m[i]) AS step FROM raw),
placed AS (SELECT doc_id, no, m, CAST(sum(step) OVER (PARTITION BY doc_id, no ORDER BY i) AS BIGINT) AS e FROM each),
found AS (SELECT doc_id, no, e - length(m) AS s, e FROM placed WHERE CASE no {" ".join(
    f"WHEN {i} THEN " + _KEEP_SQL[k.name].format(p=k.pattern.replace("'", "''")) for i, k in enumerate(secrets.KINDS))} END),
base AS (SELECT * FROM found WHERE no < 3),
weak AS (SELECT * FROM found l WHERE no >= 3 AND NOT EXISTS (
  SELECT 1 FROM base r WHERE r.doc_id = l.doc_id AND r.s <= l.e AND l.s <= r.e)),
listed AS (
  SELECT * FROM base
  UNION ALL SELECT * FROM weak l WHERE no = 3 AND EXISTS (SELECT 1 FROM found r WHERE r.no IN (0, 2, 4) AND {_NEAR})
  UNION ALL SELECT * FROM weak l WHERE no = 4 AND EXISTS (SELECT 1 FROM found r WHERE r.no IN (1, 3) AND {_NEAR})
  UNION ALL SELECT * FROM weak l WHERE no = 5 AND EXISTS (SELECT 1 FROM found r WHERE r.no IN (0, 2, 4) AND {_NEAR})
    AND EXISTS (SELECT 1 FROM found r WHERE r.no IN (1, 3) AND {_NEAR})),
named AS (SELECT doc_id, no, s, (['assign', 'access', 'hex', 'ident', 'key', 'endpoint'])[no + 1] || ':' || s || ':' || e AS x FROM listed),
sums AS (SELECT doc_id, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
  coalesce(string_agg(x, ',' ORDER BY s, no) FILTER (no < 3), '') AS base, string_agg(x, ',' ORDER BY s, no) AS spans
  FROM named GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN sums USING (doc_id)
"""


@query("op9_credential_linking", OP9_SQL)
def op9(spark, sf):
    return secrets.digest(secrets.report(table(spark, sf, "documents")))


LAG, SPAN = 500, 4096
_CANONICAL = r"""
  regexp_replace(regexp_replace(lower(regexp_extract(place, '^([^/]*)', 1)), '^[^@]*@|:(80|443)$', '', 'g'), '^www\.', '')
  || regexp_replace(regexp_extract(place, '^[^/]*(.*)$', 1), '/+$', '')
  || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END"""
OP6_SQL = rf"""
WITH bare AS (SELECT page_id, md5(coalesce(html, '')) AS tag, strlen(coalesce(html, '')) AS size,
  regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages),
parts AS (SELECT *, regexp_extract(u, '^([^?]*)', 1) AS place,
  list_sort([p FOR p IN string_split(regexp_extract(u, '[?](.*)$', 1), '&')
    IF p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid)(=|$)')]) AS kept FROM bare),
named AS (SELECT page_id, tag, size, {_CANONICAL} AS canonical_url FROM parts),
asked AS (SELECT *, page_id + {LAG} AS asked_at FROM named),
met AS (SELECT a.page_id, a.canonical_url, a.asked_at, a.tag, r.page_id AS response_at, r.tag AS response_tag, r.size
  FROM asked a ASOF LEFT JOIN named r ON a.canonical_url = r.canonical_url AND a.asked_at >= r.page_id)
SELECT 'b' || page_id AS record_id, canonical_url, asked_at AS "at", 'a' || response_at AS response_id, response_at,
  CASE WHEN response_at IS NULL THEN 'missing' WHEN tag = response_tag THEN 'resolved' ELSE 'changed' END AS state,
  CASE WHEN tag = response_tag THEN 'content-length=' || size || ';date=day ' || (asked_at // 100) || ';etag=W/"' || tag || '"' END AS headers
FROM met
"""


@query("op6_revisit_resolution", OP6_SQL)
def op6(spark, sf):
    found = warc.resolved(warc.second_crawl(table(spark, sf, "pages"), LAG), SPAN)
    listed = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.withColumn("headers", F.array_join(listed, ";"))


def _license_sql() -> str:
    made = licenses.compiled()
    known = ", ".join(f"('{s}', {i + 1})" for i, s in enumerate(made.sentences))

    def ids(text: str) -> str:
        return f"""(SELECT coalesce(list(k.id ORDER BY x.i), []) FROM (
          SELECT unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM (
            SELECT string_split(regexp_replace({text}, '([.;:!?])[\x20\t]+', '\1' || chr(10), 'g'), chr(10)) AS ss)) x
          JOIN known k ON k.s = trim(regexp_replace(lower(x.s), '[^a-z0-9]+', ' ', 'g')))"""

    def names(column: str) -> str:
        out = f"array_to_string([('<' || i || '>') FOR i IN {column}], '')"
        for name, sequence in made.rules:
            out = f"replace({out}, '{''.join(f'<{i}>' for i in sequence)}', '[{name}]')"
        return rf"regexp_extract_all({out}, '\[([^\]]+)\]', 1)"

    return f"""
WITH known(s, id) AS (VALUES {known}),
d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\n\r]+', ' ', 'g') AS u FROM documents),
read AS (SELECT doc_id, {ids('t')} AS a, {ids('u')} AS b FROM d)
SELECT doc_id, array_to_string(CASE WHEN len(b) > len(a) THEN b ELSE a END, ',') AS sentences,
  array_to_string(list_sort(list_distinct(list_concat({names('a')}, {names('b')}))), ',') AS licenses
FROM read
"""


@query("op8_license_rules", _license_sql())
def op8(spark, sf):
    found = licenses.licenses(table(spark, sf, "documents"))
    joined = F.array_join(F.transform("sentences", lambda i: i.cast("string")), ",")
    return found.select("doc_id", joined.alias("sentences"), F.array_join("licenses", ",").alias("licenses"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)
