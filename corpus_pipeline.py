"""From raw documents to token ids, in five stages.

Each stage is a function of ``(spark, docs, sf_dir)`` that works on all its
predecessor kept; its result is written as Parquet and read again as the
next one's documents. All but the last return the columns of ``documents``:

1. language ID drops documents whose language it rejects (text that is
   null, has no letter, or is unlike every learned language);
2. MinHash near-dedup (five-word shingles, similarity 0.8) leaves one
   document of each group; rows that repeat a doc_id are documents each;
3. benchmark decontamination drops documents that share a ten-word window
   with a benchmark item;
4. the secret scan masks secrets in the texts;
5. SentencePiece encoding returns ``doc_id, n_tokens, ids`` (little-endian
   unsigned 32-bit integers) and the digests of ids and decoded text.

An empty table passes through as an empty table. Columns besides those of
``documents`` pass through, whatever their names; null ids stay; very long
texts are whole throughout.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytiles.llm import decontaminate, language, neardup, secrets, sentencepieces
from skytiles.llm.common import read_table
from skytiles.llm.queries import PIECE_MODEL
from skytiles.session import scratch_scope, scratch_scope_off, write_scratch_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled texts of its input; without any there is
    nothing to recognise by, and all documents stay."""
    model = language.fit(docs)
    return language.keep_accepted(docs, model) if model.languages else docs


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs, length_col="n_chars")


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = sentencepieces.encode_documents(docs, public_tokenizers.path(PIECE_MODEL))
    return pieces.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

# Language ID and token ids cannot be said in SQL; the pipeline is tested
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark):          # a stage's own tables go with it
            kept = stage(spark, docs, sf_dir)
            with scratch_scope_off():
                docs = write_scratch_table(kept, f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
