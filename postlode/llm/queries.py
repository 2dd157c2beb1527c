"""The training-data operators as registered queries, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.llm import (
    bbit_minhash,
    compression,
    diagonal_align,
    filter_audit,
    lattice,
    line_dedup,
    line_quality,
    packing,
    pfor,
    phrase_index,
    simhash,
    suffix_dedup,
    warc,
)
from postlode.llm.shared import crc_remainder, use_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Strips and splits at ASCII white space; lower-cases A-Z alone.
SPACES = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def quality_model(documents: DataFrame, labels: DataFrame) -> compression.Model:
    """Learnt from the rows that op8 may learn from."""
    learnt = labels.where(crc_remainder("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    return compression.fit(documents, learnt)


KEEP_FROM = 0.3


@query
def op8_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of quality label 1 for every document, from compressed sizes."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(documents, table(spark, sf_dir, "labels"))
    return compression.score(documents, model).select(
        "doc_id",
        (crc_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
    )


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the digest of what stays of every document."""
    return line_dedup.digests(table(spark, sf_dir, "documents"))


ORACLES["op9_line_dedup"] = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line, {LOWER.format(f"trim(line, {SPACES})")} AS key FROM lines
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone
    FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_phrase_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in an occurrence of a benchmark window."""
    return phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from the block files."""
    manifest = pfor.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pfor.read_tokens(manifest)


@query
def op6_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of a document in a sequence."""
    documents = table(spark, sf_dir, "documents")
    return packing.pack(documents, tokenizer_path("byte_bpe_50k.json"), with_ids=False).drop("ids")


@query
def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives."""
    manifest = warc.write_archives(warc.page_records(table(spark, sf_dir, "pages")))
    records = warc.read_archives(manifest).where("gap is null")
    return records.select(
        warc.page_number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_number("refers_to").alias("refers_to"),
    )


ORACLES["op1_warc_salvage"] = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM payloads
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM firsts
"""


@query
def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of line-first cleaning for every document."""
    return line_quality.judge(table(spark, sf_dir, "documents")).drop("clean_text")


@query
def op3_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add-one and lattice log10 probability of every document."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (crc_remainder("doc_id", 7) == 2).alias("held_out")
    )
    return lattice.score(documents, tokenizer_path("piece_bpe_32k.model"))


@query
def op10_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that go as repeats of smaller ids."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by language."""
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), firsts AS (
    SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t
), marks AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels GROUP BY doc_id
), failed AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS failed
    FROM texts JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)
), counted AS (
    SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM failed GROUP BY part, failed
), letters(l) AS (
    VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), placed AS (
    SELECT *, CASE WHEN failed = '' THEN 9 ELSE
                   list_min(list_transform(string_split(failed, ''), lambda x: strpos(filter_order, x))) END AS gone
    FROM counted, orders
), steps AS (
    SELECT *, substr(filter_order, step, 1) AS letter FROM placed, range(1, 6) AS r(step)
), sums AS (
    SELECT part, filter_order, step, letter,
           sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
           sum(n) FILTER (contains(failed, letter) AND gone < step) AS redundant,
           sum(n) FILTER (failed = letter) AS unique_fails,
           sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
    FROM steps GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept,
       coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
       coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM sums
"""


@query
def op11_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and near-duplicate component of every document."""
    return bbit_minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


@query
def op12_diagonal_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' ids for every document."""
    documents = table(spark, sf_dir, "documents")
    return diagonal_align.digests(documents, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
