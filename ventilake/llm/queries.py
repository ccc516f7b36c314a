"""Registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventilake.llm import license_scan as licenses
from ventilake.llm.common import table
from ventilake.llm.decontaminate import decontaminate
from ventilake.llm.embedding_dedup import embedding_dedup
from ventilake.llm.exact_dedup import exact_dedup, sha256
from ventilake.llm.fill_in_middle import fill_in_middle, restored
from ventilake.llm.html_extract import extract_main_text
from ventilake.llm.importance import importance_resample
from ventilake.llm.near_dedup import near_dedup
from ventilake.llm.packing import default_tokenizer, pack
from ventilake.llm.paragraph_dedup import repeated_paragraphs
from ventilake.llm.pii import pii
from ventilake.llm.quality import quality
from ventilake.llm.toxicity import toxicity


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select(
        *["doc_id", "n", "form", "prefix_chars", "middle_chars"],
        sha256(F.col("output")).alias("output_sha256"),
        sha256(restored("output", "form")).alias("restored_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


EXACT_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), r AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id NULLS LAST) AS keep_id
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""

DECONTAMINATE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)
), bw AS (
  SELECT item_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM benchmark)
), pat AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, list_slice(w, i, i + least(10, len(w)) - 1) AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT m FROM pat),
pos AS (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM dw, sizes WHERE len(w) >= m),
occ AS (SELECT p.doc_id, p.i, p.m, pat.item_id FROM pos p JOIN pat ON p.m = pat.m AND list_slice(p.w, p.i, p.i + p.m - 1) = pat.win),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS x FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, len(dw.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


#: all pairs of a label
EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(least(c.c, e.vec_id), e.vec_id) AS component_id,
       e.vec_id = coalesce(least(c.c, e.vec_id), e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) n ON e.vec_id = n.a
LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) c ON e.vec_id = c.a
"""

#: checksums byte by byte, over distinct features
IMPORTANCE_SQL = r"""
WITH byte_step AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS step
), w AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), g AS (
  SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
         list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM w
), n AS (SELECT side, id, f, count(*) AS n FROM g GROUP BY ALL),
distinct_f AS (SELECT DISTINCT f FROM n),
b AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))),
              lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM distinct_f, byte_step
), c AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM n JOIN b USING (f) GROUP BY bucket
), total AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM c),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM c, total
), per_doc AS (
  SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM n JOIN b USING (f) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || CAST(w.id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN per_doc USING (id) WHERE side = 'd'
), r AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS able FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * able // 100 THEN place END AS rank FROM r
"""

FILL_IN_MIDDLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units, list_transform(range(4), lambda k: CAST('0x' || h[8 * k + 1 : 8 * k + 8] AS BIGINT)) AS h FROM d
), c AS (
  SELECT *, len(units) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a,
         greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b FROM u
), p AS (
  SELECT doc_id, t, n, array_to_string(units[1 : a], '') AS pre, array_to_string(units[a + 1 : b], '') AS mid, array_to_string(units[b + 1 : n], '') AS suf,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_pii": op3_pii,
        "op4_html_extract": op4_html_extract,
        "op5_toxicity": op5_toxicity,
        "op6_near_dedup": op6_near_dedup,
        "op7_decontaminate": op7_decontaminate,
        "op8_paragraph_dedup": op8_paragraph_dedup,
        "op9_quality": op9_quality,
        "op10_packing": op10_packing,
        "op11_embedding_dedup": op11_embedding_dedup,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_fill_in_middle": op13_fill_in_middle,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": licenses.oracle_sql(),
        "op2_exact_dedup": EXACT_SQL,
        "op7_decontaminate": DECONTAMINATE_SQL,
        "op11_embedding_dedup": EMBEDDING_SQL,
        "op12_importance_resampling": IMPORTANCE_SQL,
        "op13_fill_in_middle": FILL_IN_MIDDLE_SQL,
    }
