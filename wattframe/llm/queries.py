"""The registered queries of this package and SQL to compare them with."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .conversation_repair import damage, repair
from .conversation_sql import REPAIR, TRIE
from .exact_dedup import exact_groups
from .fingerprints import fingerprints
from .html_text import main_texts
from .line_dedup import dedup_lines
from .mixing import mix, training_order
from .ngram_join import similar_documents
from .packing import pack_documents
from .prefix_trie import in_order, prefix_trie, with_shared_beginnings
from .quality import classify
from .token_counts import token_counts
from .token_files import read_back, write_ids
from .warc import read_archives, write_archives

Query = Callable[[SparkSession, str], DataFrame]

#: Weights of 5, 2 and 1 over the training: early, even and late sources.
CURRICULUM = (((0.0, 7.5), (1.0, 2.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)))


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def _main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(write_ids(table(spark, sf_dir, "documents"), TOKENIZER, end_id=0))


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), TOKENIZER, limit=512)


def _ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"), words=4, least=85, of=100)


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024, end_id=2)


def _warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archives(table(spark, sf_dir, "pages"), revisit_from=0)
    read = read_archives(files, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete")


def _exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def _mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(mix(table(spark, sf_dir, "documents"), CURRICULUM)).drop("source", "nth", "start")


def _line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = damage(table(spark, sf_dir, "conversations"))
    lines = F.transform("repaired", lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"]))
    repaired = repair(damaged, dropped=F.col("dropped"))
    return repaired.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).drop("repaired")


def _prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = written(in_order(table(spark, sf_dir, "conversations")), "placed-turns")
    return prefix_trie(with_shared_beginnings(placed))


def queries() -> dict[str, Query]:
    return {
        "op1_prefix_fingerprints": _fingerprints,
        "op2_token_files": _token_files,
        "op3_quality_classifier": _quality,
        "op4_warc_segments": _warc,
        "op5_exact_dedup": _exact_dedup,
        "op6_token_counts": _token_counts,
        "op7_ngram_join": _ngram_join,
        "op8_best_fit_packing": _packing,
        "op9_html_text": _main_texts,
        "op10_mix_sources": _mix,
        "op11_line_dedup": _line_dedup,
        "op12_conversation_repair": _conversation_repair,
        "op13_prefix_trie": _prefix_trie,
    }


_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_EXACT_DEDUP = f"""
WITH n AS (SELECT doc_id, {_NORM} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
"""

_MIX = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1)::INT AS nth
  FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS most, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][nth % 3 + 1] AS weight FROM s),
l AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, nth) AS rank,
         (sum(source_size) OVER ()
          - coalesce(sum(most) OVER (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         )::DOUBLE / sum(weight) OVER (ORDER BY most / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         AS level
  FROM w),
t AS (
  SELECT source, source_size, nth, least(most::DOUBLE, (SELECT arg_min(level, rank) FROM l WHERE level * weight <= most)
         * weight) AS target
  FROM l),
c AS (
  SELECT d.*, source_size, nth, target, floor(target / greatest(source_size, 1))::BIGINT AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, least(3, whole + CASE WHEN start + size / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END)
            ::BIGINT AS passes,
         least(1.0, (start + size / 2.0::DOUBLE) / greatest(target, 1.0)) AS share
  FROM c)
SELECT doc_id, size, source_size, target, passes * size AS taken, passes,
       CASE WHEN passes > 0 THEN CASE nth % 3
         WHEN 0 THEN 0.0::DOUBLE + (sqrt(greatest(0.0, 56.25::DOUBLE + -10.0::DOUBLE * (share * 5.0::DOUBLE - 0.0)))
                                    - 7.5::DOUBLE) / -5.0::DOUBLE
         WHEN 1 THEN 0.0::DOUBLE + (share * 2.0::DOUBLE - 0.0) / 2.0::DOUBLE
         ELSE 0.0::DOUBLE + (sqrt(greatest(0.0, 0.25::DOUBLE + 2.0::DOUBLE * (share * 1.0::DOUBLE - 0.0)))
                             - 0.5::DOUBLE) / 1.0::DOUBLE
       END END AS position
FROM p
"""


_LINE_DEDUP = """
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM s),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.*, last IS NOT NULL AND last <> doc_id AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_exact_dedup": _EXACT_DEDUP,
        "op10_mix_sources": _MIX,
        "op11_line_dedup": _LINE_DEDUP,
        "op12_conversation_repair": REPAIR,
        "op13_prefix_trie": TRIE,
    }
