"""The registered query of each operator and, where SQL can say it, its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .chosen_path import similar_groups
from .common import table
from .decontaminate import contaminated
from .exact_dedup import exact_groups
from .filter_audit import filter_interactions
from .html_extract import extract_main_text
from .license_scan import scan_licenses
from .packing import pack
from .quality_cnn import fit, quality_scores
from .simhash_dedup import simhash_components
from .token_files import read_token_files, token_file_folder, write_token_files
from .tokens import default_tokenizer
from .toxicity import toxicity_scores
from .vector_codes import encode_vectors
from .warc import archive_folder, read_archives, write_archives


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer(), length=1024, max_segments=64, max_loss=1024,
                remember=1_500_000)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = archive_folder(spark)
    manifest = write_archives(table(spark, sf_dir, "pages"), folder, revisit_from=100)
    return read_archives(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), containment=0.8, span=2.0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit(docs, table(spark, sf_dir, "labels")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_file_folder(spark)
    manifest = write_token_files(table(spark, sf_dir, "documents"), default_tokenizer(), folder)
    return read_token_files(manifest, folder)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_vectors(table(spark, sf_dir, "embeddings"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"), width=2, threshold=80)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_pack, op2_decontaminate, op3_html_text, op4_warc, op5_license_scan, op6_quality, op7_toxicity,
    op8_simhash_near_dedup, op9_exact_dedup, op10_token_files, op11_vector_codes, op12_minhash_near_dedup, op13_filter_audit)}

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Each round as plain SQL: all distances, the least of them, the means."""
    nearest = """d{k} AS MATERIALIZED (SELECT x.vec_id, x.p, c.e, sum((x.v - c.v) * (x.v - c.v)) AS d
    FROM x JOIN c{k} c USING (p, i) GROUP BY x.vec_id, x.p, c.e),
 a{k} AS MATERIALIZED (SELECT vec_id, p, min(d * 256 + e) % 256 AS e, min(d) AS d FROM d{k} GROUP BY vec_id, p)"""
    moved = """m{k} AS (SELECT x.p, a.e, x.i, sum(x.v) AS s, count(*) AS n
    FROM x JOIN a{k} a USING (vec_id, p) GROUP BY x.p, a.e, x.i),
 c{next} AS MATERIALIZED (SELECT c.p, c.e, c.i, CASE WHEN m.n IS NULL THEN c.v ELSE
    CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT) END AS v
    FROM c{k} c LEFT JOIN m{k} m USING (p, e, i))"""
    chain = ",\n ".join(nearest.format(k=k) + ",\n " + moved.format(k=k, next=k + 1) for k in range(rounds))
    return f"""
WITH k AS (SELECT vec_id, label, embedding, len(embedding) // {parts} AS w FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
 u AS (SELECT vec_id, w, generate_subscripts(embedding, 1) - 1 AS place,
    CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v FROM k),
 x AS MATERIALIZED (SELECT vec_id, place // w AS p, place % w AS i, v FROM u),
 s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k),
 c0 AS MATERIALIZED (SELECT x.p, s.e, x.i, x.v FROM x JOIN s USING (vec_id) WHERE s.e < {entries}),
 {chain},
 {nearest.format(k=rounds)},
 r AS (SELECT vec_id, string_agg(lpad(lower(to_hex(CAST(e AS INTEGER))), 2, '0'), '' ORDER BY p) AS code,
    CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT r.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, i)) FROM c{rounds}) AS codebooks_sha256
FROM r JOIN k USING (vec_id)"""


ORACLE_SQL = {
    "op11_vector_codes": _vector_codes_sql(),
    "op12_minhash_near_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS MATERIALIZED (SELECT doc_id, CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w ELSE
        list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM d),
 g AS MATERIALIZED (SELECT doc_id, unnest(g) AS x FROM s),
 c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM g a JOIN g b USING (x)
       WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
 l AS MATERIALIZED (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
       WHERE 100 * n >= 80 * (len(x.g) + len(y.g) - n)),
 e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
 r AS (SELECT doc_id, doc_id AS at FROM s UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.at)
SELECT s.doc_id, CAST(any_value(len(s.g)) AS BIGINT) AS n_shingles, min(r.at) AS component_id, s.doc_id = min(r.at) AS kept
FROM s JOIN r USING (doc_id) GROUP BY s.doc_id""",
    "op13_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
 f AS (SELECT doc_id, part,
        [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
         doc_id > min(doc_id) OVER (PARTITION BY t)] AS fails FROM d),
 g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
       FROM f LEFT JOIN labels USING (doc_id) GROUP BY part, fails),
 l AS (SELECT unnest(range(1, 6)) AS k),
 o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM l a, l b, l c, l d, l e
       WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
 p AS (SELECT o, unnest(range(1, 6)) AS step FROM o),
 r AS (SELECT part, o, step, n, good, toxic, fails[o[step]] AS it,
        list_bool_or([false] || list_transform(o[:step - 1], lambda k: fails[k])) AS went,
        len(list_filter(fails, lambda x: x)) AS m FROM g, p)
SELECT part, list_aggregate(list_transform(o, lambda k: chr(CAST(64 + k AS INTEGER))), 'string_agg', '') AS filter_order,
    CAST(step AS INTEGER) AS step,
    CAST(coalesce(sum(n) FILTER (NOT it AND NOT went), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (it AND NOT went), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (it AND went), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (it AND m = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (it AND NOT went), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (it AND NOT went), 0) AS BIGINT) AS toxic_lost,
    CAST(sum(coalesce(sum(n) FILTER (it AND NOT went), 0)) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM r GROUP BY part, o, step""",
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS n, sha256(html) AS h FROM p),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM f""",
    "op9_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_ASCII_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d""",
}
