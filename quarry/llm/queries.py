"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can
express the result. Each query applies its operator to the whole table and derives the
contract's columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import toxicity, whitening
from quarry.llm.exact_dedup import exact_groups
from quarry.llm.line_dedup import LEAST_PAGES, RATIO, line_dedup
from quarry.llm.mixing import mix
from quarry.llm.pieces import encoded
from quarry.llm.pii import BASE as PII_BASE
from quarry.llm.pii import pii_spans
from quarry.llm.quality_rules import judged
from quarry.llm.quality_trees import THRESHOLD, held_out, scored, train
from quarry.llm.secret_scan import BASE as SECRET_BASE
from quarry.llm.secret_scan import scanned
from quarry.llm.simhash import simhash_components
from quarry.llm.spelling import spelling_groups
from quarry.llm.warc import page_number, read_warc, verified, write_warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def _written(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end of an array of spans, comma-joined in its order."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans(table(spark, sf_dir, "documents"), keep=["doc_id"])
    spans = F.col("spans")
    return found.select(
        "doc_id", *[_of_kind(spans, k).alias(f"n_{k}") for k in PII_BASE],
        F.sha2(_written(spans, PII_BASE).cast("binary"), 256).alias("base_sha256"), _written(spans).alias("spans"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("keep_key").alias("keep_id"), F.col("rows").alias("group_size"),
                        "kept", F.col("digest").alias("text_sha256"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM k
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", F.size("kept_lines").alias("n_kept"), "n_lines",
                        F.sha2(F.array_join("kept_lines", "\n").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = rf"""
WITH cut AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)', '', 'g'),
      '(?i)</?(?:html|head|title|body|main|article|section|header|footer|nav|aside|div|p|ul|ol|li|h1|h2|h3|h4|h5|h6|br|hr|table|tr|td|th|pre|blockquote|form)\b[^>]*>', chr(10), 'g'),
      '<[^>]*>', '', 'g'), chr(10)),
      lambda x: regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')), lambda x: x <> '') AS lines
  FROM pages),
totals AS (SELECT host, count(*) AS pages FROM cut WHERE host <> '' GROUP BY host),
counts AS (
  SELECT host, line, count(*) AS pages_with
  FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM cut WHERE host <> '') GROUP BY host, line),
common AS (
  SELECT c.host, list(c.line) AS common FROM counts c JOIN totals t ON c.host = t.host
  WHERE c.pages_with >= {LEAST_PAGES} AND c.pages_with > {RATIO}e0 * t.pages GROUP BY c.host),
kept AS (
  SELECT page_id, cut.host, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(common.common, []), x)) AS kept
  FROM cut LEFT JOIN common ON cut.host = common.host)
SELECT page_id, host, CAST(len(kept) AS INTEGER) AS n_kept, CAST(len(lines) AS INTEGER) AS n_lines,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
FROM kept
"""


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix-1:' || CAST(doc_id AS VARCHAR)) AS shuffle,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS words FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM per),
weighted AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3e0 WHEN 1 THEN 1e0 ELSE 2e0 END AS weight,
         CAST(2 * words AS DOUBLE) AS cap, CAST(sum(words) OVER () AS DOUBLE) * 1.5e0 AS budget
  FROM ranked),
filling AS (
  SELECT *, cap / weight AS level,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS full_caps,
         sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM weighted),
water AS (
  SELECT (budget - full_caps) / open_weight AS reach FROM filling
  WHERE (budget - full_caps) / open_weight <= level ORDER BY level, rank LIMIT 1),
sources AS (
  SELECT source, rank, words, weight, budget, least(cap, (SELECT reach FROM water) * weight) AS target FROM filling),
once AS (
  SELECT s.doc_id, s.size, s.shuffle, t.rank, t.words, t.weight, t.budget, t.target,
         sum(s.size) OVER (PARTITION BY t.rank ORDER BY s.shuffle, s.doc_id ROWS UNBOUNDED PRECEDING) AS run
  FROM sized s JOIN sources t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT doc_id, size, rank, shuffle, budget, CAST(run + e * words AS DOUBLE) / weight AS finish
  FROM once, (SELECT unnest([0, 1]) AS e) WHERE size > 0),
queue AS (
  SELECT doc_id, budget, sum(size) OVER (ORDER BY finish, rank, shuffle, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM copies),
taken AS (SELECT doc_id, count(*) AS copies FROM queue WHERE upto <= floor(budget) GROUP BY doc_id)
SELECT o.doc_id, CAST(o.size AS BIGINT) AS size, o.words AS source_size, o.target,
       CAST(o.size * coalesce(t.copies, 0) AS BIGINT) AS taken
FROM once o LEFT JOIN taken t ON o.doc_id = t.doc_id
"""


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    spans = F.col("spans")
    return found.select(
        "doc_id", *[_of_kind(spans, k).alias(f"n_{k}") for k in SECRET_BASE],
        F.sha2(_written(spans, SECRET_BASE).cast("binary"), 256).alias("base_sha256"), _written(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["structure"].isNotNull())).cast("long").alias("n_confirmed"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_warc(table(spark, sf_dir, "pages"))
    found = verified(read_warc(archives, payloads=False), archives)
    return found.select(page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", page_number(F.col("refers_to")).alias("refers_to"))


OP9_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first,
    array_to_string(list_transform(range(0, 8), lambda i: (
      array_to_string(list_transform(range(0, 4), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + CAST((CAST('0x' || substr(hex, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * j AS BIGINT)) & 31 AS BIGINT), 1)), ''))), '') AS payload_digest
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""


def piece_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = encoded(docs, piece_model(), keep=["doc_id"])
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "n_corrected")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    error = whitening.identity_error(rows, model)
    shares = F.array(*[F.lit(float(v / model.trace) if model.trace else None).cast("double") for v in (model.values if model else [])])
    found = whitening.whitened(rows, model, keep=["vec_id"])
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else None).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("at")).cast("double").alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.size("hits").alias("n_hits"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_pii": op2_pii,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_mixing": op6_mixing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_secrets": op8_secrets,
    "op9_warc": op9_warc,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_whitening": op11_whitening,
    "op12_toxicity": op12_toxicity,
    "op13_spelling": op13_spelling,
}

ORACLE = {"op3_exact_dedup": OP3_SQL, "op4_line_dedup": OP4_SQL, "op6_mixing": OP6_SQL, "op9_warc": OP9_SQL}
