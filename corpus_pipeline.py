"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table, which is written and read again as the next
stage's documents. Stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.llm import compression, line_dedup, packing, phrase_index, simhash
from postlode.llm.queries import KEEP_FROM, quality_model, table, tokenizer_path
from postlode.llm.shared import free_name, stored, use_settings


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; the labels are those of its input's ids."""
    use_settings(spark)
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "score")
    return compression.score(docs, model, to=name).where(F.col(name) >= KEEP_FROM).drop(name)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines, all rows kept; ``n_chars`` follows the text."""
    use_settings(spark)
    kept = line_dedup.without_repeats(docs)
    changed = kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return changed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in docs.schema.fields])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each near-duplicate group."""
    use_settings(spark)
    return simhash.one_per_group(docs, shingle_words=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window."""
    use_settings(spark)
    return phrase_index.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, with their ids."""
    use_settings(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]

# Compression, fingerprints and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
