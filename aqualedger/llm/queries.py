"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact, fim, importance, knn, langid, licenses, lines, merkle, minhash, mixing, packing, simhash, toxicity
from .util import materialize, table


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the pages' WARC records against a replica derived from them: in it, some records
    have rotted (first letter overwritten), some are missing and some are held by it alone.
    Pages with a null id are records like others."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    html = F.when(size % 11 == 5, F.concat(F.lit("~"), F.substring("html", 2, 2**31 - 1))).otherwise(F.col("html"))
    payload = merkle.warc_payload(html="rotted")
    copy = pages.withColumn("rotted", html).select(
        F.col("page_id").cast("long").alias("copy_id"), F.sha2(merkle.warc_payload(), 256).alias("original"), F.octet_length(payload).cast("long").alias("copied"),
        F.sha2(payload, 256).alias("copy_digest"), (size % 29 == 7).alias("lost"), (size % 31 == 3).alias("stray"),
    )
    # the copy's records lie where the originals do
    same = F.col("page_id").eqNullSafe(F.col("copy_id")) & (F.col("digest") == F.col("original"))
    both = materialize(merkle.warc_records(pages).join(copy.distinct(), same), "warc-records")
    good = both.where("not stray").select("file", "offset", "length", "digest")
    replica = both.where("not lost").select("file", "offset", F.col("copied").alias("length"), F.col("copy_digest").alias("digest"))
    return merkle.audit(good, replica)


def op2_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into bins of 4096 words, copies and crowded sources kept apart."""
    return packing.best_fit(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents interleaved by source, each source's target weight the root of its documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, weights=0.5).select("doc_id", "source", "mix_slot", "mix_pos")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup (keys of at least 10 code points) leaves of every document."""
    left = lines.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=10)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document; the largest doc_id stays."""
    found = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector with all others."""
    rows = knn.quantized(table(spark, sf_dir, "embeddings"))
    return knn.top_k(rows, F.col("vec_id") % 50 == 0, k=5)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the documents that are not held out."""
    return langid.predict_language(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 4-word shingles, at most 4 differing bits."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weights of all documents towards the benchmark, and the drawn 5 percent in order."""
    scores = importance.importance_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=5)
    return scores.select("doc_id", "n_features", "weight", "score", "rank")


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document, with digests of the output and of the text rebuilt from it."""
    cut = fim.fill_in_middle(table(spark, sf_dir, "documents"), seed=1)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(), 256).alias("restored_sha256"),
    )


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash components of all documents: 4-word shingles, similarity of at least 0.8."""
    return minhash.minhash_components(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_merkle_fixity": op1_merkle_fixity,
    "op2_best_fit": op2_best_fit,
    "op3_mixing": op3_mixing,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_knn": op6_knn,
    "op7_toxicity": op7_toxicity,
    "op8_language": op8_language,
    "op9_simhash": op9_simhash,
    "op10_license_scan": op10_license_scan,
    "op11_importance": op11_importance,
    "op12_fim": op12_fim,
    "op13_minhash": op13_minhash,
}

ORACLE_SQL: dict[str, str] = {
    "op11_importance": r"""
WITH crc_table AS (
  SELECT list(list_reduce([v] || range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY v) AS t
  FROM range(256) r(v)),
texts AS (
  SELECT false AS aim, doc_id, text FROM documents UNION ALL SELECT true, NULL, text FROM benchmark),
words AS (
  SELECT aim, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
grams AS (
  SELECT aim, doc_id, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i]) ||
         list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ||
         list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g
  FROM words),
counted AS (SELECT aim, doc_id, g, count(*) AS c FROM grams GROUP BY ALL),
bytes AS (
  SELECT g, list_transform(range(0, strlen(g)), lambda i: CAST('0x' || substr(hex(encode(g)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS b
  FROM (SELECT DISTINCT g FROM counted)),
hashed AS (
  SELECT g, xor(list_reduce([4294967295] || b, lambda x, y: xor(x >> 8, t[1 + (xor(x, y) & 255)])), 4294967295) % 10000 AS bucket FROM bytes, crc_table),
features AS (SELECT aim, doc_id, bucket, sum(c) AS c FROM counted JOIN hashed USING (g) GROUP BY ALL),
seen AS (
  SELECT bucket, CAST(coalesce(sum(c) FILTER (NOT aim), 0) AS DOUBLE) AS s, CAST(coalesce(sum(c) FILTER (aim), 0) AS DOUBLE) AS t FROM features GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM seen),
weights AS (SELECT doc_id, CAST(sum(c) AS BIGINT) AS n_features, CAST(sum(c * gain) AS BIGINT) AS weight FROM features JOIN gains USING (bucket) WHERE NOT aim GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS enough,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (doc_id) WHERE NOT aim),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id) AS place, count(*) FILTER (enough) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN enough AND place <= 5 * n // 100 THEN place END AS rank FROM placed
""",
    "op13_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, v FROM reach JOIN both_ways ON u = seen)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(seen) AS component_id, doc_id = min(seen) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
""",
    "op12_fim": r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
heads AS (
  SELECT doc_id, t, n, CAST('0x' || substr(d, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (n + 1) AS b,
         CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 AS s FROM drawn),
cuts AS (
  SELECT doc_id, t, n, least(a, b) AS i, greatest(a, b) AS j,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
              WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form FROM heads),
parts AS (
  SELECT *, substr(t, 1, i) AS prefix, substr(t, i + 1, j - i) AS middle, substr(t, j + 1) AS suffix FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""",
    "op1_merkle_fixity": r"""
WITH parts AS (
  SELECT page_id, page_id // 1024 AS file,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
           || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' AS head,
         chr(13) || chr(10) || chr(13) || chr(10) AS gap, coalesce(html, '') AS body,
         CASE WHEN strlen(html) % 11 = 5 THEN '~' || substr(html, 2) ELSE coalesce(html, '') END AS rotted,
         coalesce(strlen(html) % 29 = 7, false) AS lost, coalesce(strlen(html) % 31 = 3, false) AS stray
  FROM pages),
records AS (
  SELECT page_id, file, lost, stray, head || strlen(body) || gap || body || gap AS a, head || strlen(rotted) || gap || rotted || gap AS b FROM parts),
placed AS (
  SELECT file, lost, stray, strlen(a) AS length_a, strlen(b) AS len_b, sha256(a) AS digest_a, sha256(b) AS dig_b,
         sum(strlen(a)) OVER (PARTITION BY file ORDER BY page_id) - strlen(a) AS "offset"
  FROM records)
SELECT file, CAST("offset" // 65536 AS BIGINT) AS leaf, CAST("offset" AS BIGINT) AS "offset",
       CASE WHEN lost THEN 'missing' WHEN stray THEN 'extra' ELSE 'changed' END AS kind, CASE WHEN NOT stray THEN length_a END AS length_a,
       CASE WHEN NOT lost THEN len_b END AS length_b, CASE WHEN NOT stray THEN digest_a END AS digest_a, CASE WHEN NOT lost THEN dig_b END AS digest_b
FROM placed WHERE NOT (lost AND stray) AND (lost OR stray OR digest_a <> dig_b)
""",
    "op4_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT doc_id, pos, line, (s.k IS NOT NULL AND doc_id <> keeper) AS gone
  FROM keyed LEFT JOIN shared s USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op5_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
    "op6_knn": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5
""",
}
