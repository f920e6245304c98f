"""The operators of this package as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, decontaminate, exact, langid, licenses, pages, pieces, pii, simhash, substrings, topk, transcripts, whitening
from ledgerloom.llm.common import table


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", "n_found", "n_changed")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.format_turns(table(spark, sf_dir, "conversations"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_pseudonyms": op1_pii_pseudonyms,
    "op2_chat_format": op2_chat_format,
    "op3_language_id": op3_language_id,
    "op4_html_extraction": op4_html_extraction,
    "op5_exact_topk": op5_exact_topk,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_phrase_collocations": op13_phrase_collocations,
}

OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS rid
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM wins),
spots AS (
  SELECT rid, s, k, array_to_string(w[s : s + k - 1], ' ') AS win
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM words, sizes WHERE len(w) >= k)),
found AS (SELECT rid, s, spots.k, item_id FROM spots JOIN wins ON spots.win = wins.win AND spots.k = wins.k),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM found) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS joined
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)
"""

OP5_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row_no AS q_row, q.vec_id AS query_id, x.vec_id, x.row_no,
         CAST(list_inner_product(CAST(q.c AS DOUBLE[]), CAST(x.c AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.row_no <> x.row_no WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_row ORDER BY score DESC, vec_id, row_no) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP6_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT rid, s, hash(array_to_string(w[s : s + 34], ' ')) AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS s FROM docs WHERE len(w) >= 35)),
twice AS (SELECT win FROM wins GROUP BY win HAVING count(*) > 1),
gone AS (SELECT rid, list(DISTINCT p) AS ps FROM (SELECT rid, unnest(range(s, s + 35)) AS p FROM wins WHERE win IN (SELECT win FROM twice)) GROUP BY rid),
kept AS (
  SELECT rid, string_agg(x, ' ' ORDER BY p) AS t FROM (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM docs)
  ANTI JOIN (SELECT rid, unnest(ps) AS p FROM gone) g USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)
"""

OP12_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""

OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (
  SELECT lang, k, w[s : s + k - 1] AS v, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM w), (VALUES (1), (2), (3), (4)) AS lengths(k)
  WHERE s + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.k, c.v, c.f AS a, l.f AS l, r.f AS r, l.k AS cut,
         CAST(CAST(2000000 AS HUGEINT) * c.f // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM f c JOIN f l ON l.lang = c.lang AND l.k < c.k AND l.v = c.v[1 : l.k]
           JOIN f r ON r.lang = c.lang AND r.k = c.k - l.k AND r.v = c.v[l.k + 1 : c.k]),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, v ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT b.lang, b.v[s : s + m - 1] AS v, m AS k, b.f
  FROM f b, (VALUES (2), (3)) AS shorter(m), (VALUES (1), (2), (3)) AS starts(s) WHERE m < b.k AND s + m - 1 <= b.k),
gone AS (SELECT DISTINCT low.lang, low.v FROM low JOIN inside i ON i.lang = low.lang AND i.k = low.k AND i.v = low.v WHERE CAST(100 AS HUGEINT) * i.f >= CAST(80 AS HUGEINT) * low.a),
kept AS (SELECT lang, array_to_string(v, ' ') AS phrase, a, l, r, score FROM low ANTI JOIN gone USING (lang, v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op12_exact_dedup": OP12_SQL,
    "op13_phrase_collocations": OP13_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op5_exact_topk": OP5_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
}
