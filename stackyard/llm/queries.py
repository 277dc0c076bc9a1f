"""The registered queries of this subpackage: thin forms of its operators.

Each applies one operator, with production parameters, to the whole table
and derives the result columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, shared_root
from .conversations import damaged, repair_report
from .decontaminate import mark_leaks
from .fm_index import remove_repeated_words
from .idfiles import read_documents, write_ids
from .lines import line_report
from .packing import pack_documents
from .pu_quality import score_quality
from .quality import judge_documents
from .sharding import shard_documents
from .simhash import near_duplicates
from .suffix_array import remove_repeats
from .suffix_model import score_documents
from .vector_codes import compress_vectors

MAX_TOKENS = 2048


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the groups within two bits."""
    out = near_duplicates(documents(spark, sf_dir), shingle=3, radius=2, seed=42)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 400-byte strings that occur elsewhere."""
    return remove_repeats(documents(spark, sf_dir), 400)


def op3_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by base rules and by distance to their language."""
    return judge_documents(documents(spark, sf_dir)).drop("th")


def op4_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of nearly equal bytes."""
    return shard_documents(documents(spark, sf_dir), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), MAX_TOKENS, end_id=0)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to packed id files, then read back."""
    import uuid

    path = f"{shared_root(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    write_ids(documents(spark, sf_dir), path, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return read_documents(spark, path, digest_only=True)


def op7_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a suffix tree and by word frequencies."""
    return score_documents(documents(spark, sf_dir))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")


def op8_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold a passage of the benchmark."""
    return mark_leaks(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that each document loses as near copies of earlier lines."""
    return line_report(documents(spark, sf_dir))


def op10_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 20-word runs that occur earlier."""
    return remove_repeated_words(documents(spark, sf_dir), 20)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as eight-byte codes of trained codebooks."""
    out, books = compress_vectors(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged, with their cheapest repair."""
    return repair_report(damaged(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")))


def op13_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for quality by positive-unlabelled learning."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return score_quality(documents(spark, sf_dir), labels)[0]


def _vector_codes_sql(parts: int = 8, width: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same codes by full search: a table of parts, and a pair of tables for each round."""
    nearest = """SELECT a.vec_id, a.p, a.s, min(list_sum(list_transform(list_zip(a.s, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 256 + b.e) AS best
  FROM parts a JOIN {books} b ON a.p = b.p GROUP BY a.vec_id, a.p, a.s"""
    ctes = [f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"parts AS (SELECT vec_id, p, list_slice(v, p * {width} + 1, (p + 1) * {width}) AS s FROM kept, range({parts}) t(p))",
            f"""books0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, s AS c FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""]
    for k in range(rounds):
        ctes += [f"near{k} AS ({nearest.format(books=f'books{k}')})",
                 f"""sums{k} AS (SELECT p, best % 256 AS e, i, CAST(floor(CAST(sum(s[i]) AS DOUBLE) / count(*)) AS BIGINT) AS x
  FROM near{k}, range(1, {width + 1}) t(i) GROUP BY 1, 2, 3)""",
                 f"""books{k + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM books{k} b
  LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS c FROM sums{k} GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)"""]
    last = f"books{rounds}"
    ctes += [f"final AS ({nearest.format(books=last)})",
             """coded AS (SELECT vec_id, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code,
  CAST(sum(best // 256) AS BIGINT) AS error FROM final GROUP BY vec_id)""",
             f"sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM {last})",
             """labels_of AS (SELECT k.label, CAST(sum(c.error) AS BIGINT) AS label_error FROM kept k JOIN coded c ON k.vec_id = c.vec_id GROUP BY k.label)"""]
    return "WITH " + ",\n".join(ctes) + """
SELECT c.vec_id, c.code, c.error, l.label_error, s.codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id JOIN labels_of l ON k.label IS NOT DISTINCT FROM l.label, sha s"""


QUERIES = {f.__name__: f for f in (
    op1_simhash_vantage_points, op2_suffix_array_dedup, op3_distribution_divergence, op4_byte_shards,
    op5_best_fit_packing, op6_token_files, op7_suffix_tree_score, op8_simhash_decontamination,
    op9_fuzzy_lines, op10_fm_index_dedup, op11_vector_codes, op12_conversation_repair, op13_pu_quality)}
#: Vectors of 64 components under distinct ids, as the table has them.
SQL: dict[str, str] = {"op11_vector_codes": _vector_codes_sql()}
