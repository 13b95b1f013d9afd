"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.llm import (
    attention,
    bitslices,
    collocations,
    decontaminate,
    licences,
    packing,
    pii,
    ppm,
    rules,
    shards,
    simhash,
    suffixes,
    warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit_packing(_table(spark, folder, "documents"))


def op2_partial_matching_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return ppm.ppm_scores(_table(spark, folder, "documents"), held_out)


def op3_induced_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, folder, "documents"))


def op4_robust_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(_table(spark, folder, "documents")).drop("lang", "source", "text_key", "pool")


def op5_positional_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = (_table(spark, folder, x) for x in ("documents", "benchmark"))
    return decontaminate.decontaminate(documents, benchmark, proximity=True).drop("text_key")


def op6_training_order_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.training_order(_table(spark, folder, "documents"))


def op7_warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages"))


def op8_simhash_pivots(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, folder, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op9_licence_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licence_scan(_table(spark, folder, "documents")).drop("spans")


def op10_weak_supervision_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_spans(_table(spark, folder, "documents"))
    return found.withColumn("spans", pii.described(F.col("found"))).drop("found", "text_key")


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op12_attention_quality(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    documents, labels = (_table(spark, folder, x) for x in ("documents", "labels"))
    return attention.quality_scores(documents, labels, held_out)


def op13_bit_sliced_search(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = (_table(spark, folder, x) for x in ("documents", "benchmark"))
    return bitslices.ranked_search(documents, benchmark)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_packing,
        op2_partial_matching_scores,
        op3_induced_suffix_dedup,
        op4_robust_quality_rules,
        op5_positional_decontamination,
        op6_training_order_shards,
        op7_warc_normaliser,
        op8_simhash_pivots,
        op9_licence_automaton,
        op10_weak_supervision_pii,
        op11_phrase_collocations,
        op12_attention_quality,
        op13_bit_sliced_search,
    )
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"""list_filter(regexp_split_to_array(
  {_LOWER},
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLES: dict[str, str] = {
    "op5_positional_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS t
  FROM b, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 8))) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(t) AS n FROM win),
places AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS t
  FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN win USING (t)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
leads AS (
  SELECT item_id, t, off, t[off + 1] AS a, t[off + 2] AS b, t[off + 3] AS c
  FROM (SELECT item_id, t, unnest([0, len(t) // 3, 2 * len(t) // 3]) AS off FROM win WHERE len(t) >= 9)),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM d),
threes AS (
  SELECT doc_id, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
met AS (SELECT DISTINCT doc_id, item_id, t, i - off AS i FROM threes JOIN leads USING (a, b, c)),
near AS (
  SELECT doc_id, item_id, greatest(i, 1) AS first, least(i + len(t), len(w) + 1) AS past
  FROM met JOIN d USING (doc_id)
  WHERE len(list_filter(range(0, len(t)), lambda o: list_contains(list_slice(w, greatest(i + o - 2, 1), greatest(i + o + 2, 0)), t[o + 1]))) >= len(t) - 2
  UNION ALL SELECT doc_id, item_id, i, i + n FROM hits),
near_hit AS (SELECT doc_id, count(DISTINCT p) AS n_near
  FROM (SELECT DISTINCT doc_id, unnest(range(first, past)) AS p FROM near) GROUP BY doc_id),
near_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_near_items FROM near GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near, coalesce(n_near_items, 0) AS n_near_items
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
LEFT JOIN near_hit USING (doc_id) LEFT JOIN near_items USING (doc_id)
""",
    "op11_phrase_collocations": rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4)) AS s(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM places GROUP BY lang, k, phrase),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM f WHERE f >= 30),
cuts AS (
  SELECT lang, phrase, f, cut, array_to_string(list_slice(w, 1, cut), ' ') AS first, array_to_string(list_slice(w, cut + 1, k), ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM often WHERE k > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.cut, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * c.f) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
least AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM scored) WHERE o = 1),
inside AS (
  SELECT lang, array_to_string(list_slice(w, i, j), ' ') AS phrase, max(f) AS outer_f
  FROM (SELECT *, unnest(range(i + 1, k + 1)) AS j FROM (SELECT *, unnest(range(1, k)) AS i FROM often WHERE k > 2))
  WHERE j - i + 1 < k GROUP BY ALL),
kept AS (
  SELECT least.* FROM least LEFT JOIN inside USING (lang, phrase) WHERE coalesce(100 * outer_f, 0) < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op13_bit_sliced_search": rf"""
WITH d AS (
  SELECT * FROM (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents) WHERE len(w) > 0),
s AS (SELECT count(*) AS members, CAST(sum(len(w)) AS BIGINT) AS total FROM d),
m AS (SELECT row, doc_id, 75 + (25 * len(w) * members) // total AS m FROM d, s),
q AS (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS w FROM benchmark),
asked AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(w) AS t FROM q) GROUP BY q, t),
tf AS (
  SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM asked) GROUP BY row, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(members) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM tf, s GROUP BY t),
scored AS (
  SELECT q, row, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN tf USING (t) JOIN m USING (row) GROUP BY q, row),
ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN m USING (row) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN q USING (q) WHERE rank <= 20
""",
}
