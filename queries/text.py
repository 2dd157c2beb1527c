"""Text rules."""

from pyspark.sql import functions as F

from postlode.functions.sql import register_sql_functions
from postlode.functions.text import (
    clean_tags,
    clean_text,
    is_mojibake,
    is_non_latin,
    label_with_fallback,
    null_if_mojibake,
    repair_mojibake,
    strip_trailing_separators,
    unescape_html,
)
from postlode.operators.landing import payload_fields, repair_payload
from postlode.operators.marts import dimension
from queries.registry import corrupt, query

SPACES = r" \t\n\x0B\f\r\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}"


@query(rf"""
    SELECT doc_id,
           md5(coalesce(nullif(trim(regexp_replace(text, '[{SPACES}]+', ' ', 'g'), ' '), ''), '')) AS clean_md5,
           length(nullif(trim(regexp_replace(text, '[{SPACES}]+', ' ', 'g'), ' '), '')) AS clean_chars,
           md5(regexp_replace(text || ' , ' || chr(10), '[,{SPACES}]+$', '')) AS stripped_md5
    FROM documents""")
def clean_text_documents(t):
    """White space collapsed, blank to NULL; trailing separators off."""
    cleaned = clean_text("text")
    stripped = strip_trailing_separators(F.concat("text", F.lit(" , \n")))
    return t.documents.select(
        "doc_id",
        F.md5(F.coalesce(cleaned, F.lit(""))).alias("clean_md5"),
        F.length(cleaned).cast("bigint").alias("clean_chars"),
        F.md5(stripped).alias("stripped_md5"),
    )


@query(r"""
    SELECT doc_id,
           regexp_matches(text, '[^\x00-\x7F]') AS damaged_found,
           regexp_matches(text, '[\x{C2}-\x{F4}][\x{80}-\x{BF}]') AS clean_found,
           CASE WHEN regexp_matches(text, '[^\x00-\x7F]') THEN NULL ELSE md5(text) END AS kept_md5
    FROM documents""")
def mojibake_detect(t):
    """The damage signature in damaged and in clean text; damaged text becomes NULL."""
    damaged = corrupt(F.col("text"))
    return t.documents.select(
        "doc_id",
        is_mojibake(damaged).alias("damaged_found"),
        is_mojibake("text").alias("clean_found"),
        F.md5(null_if_mojibake(damaged)).alias("kept_md5"),
    )


@query("""
    SELECT doc_id, md5(text) AS clean_md5, md5(text) AS once_md5, md5(text) AS twice_md5
    FROM documents""")
def mojibake_repair(t):
    """Text damaged zero, one and two times over comes back as it was."""
    once = corrupt(F.col("text"))
    return t.documents.select(
        "doc_id",
        F.md5(repair_mojibake("text")).alias("clean_md5"),
        F.md5(repair_mojibake(once)).alias("once_md5"),
        F.md5(repair_mojibake(corrupt(once))).alias("twice_md5"),
    )


@query("""
    SELECT doc_id, source, md5(text) AS text_md5, doc_id AS number_kept, TRUE AS null_kept
    FROM documents""")
def payload_repair(t):
    """Strings of a nested payload repaired at any depth; numbers and nulls stay."""
    body = F.struct(F.array(corrupt(F.col("text"))).alias("parts"), F.lit(None).cast("string").alias("none"))
    payload = F.to_json(
        F.struct("doc_id", corrupt(F.col("source")).alias("source"), body.alias("body")),
        {"ignoreNullFields": "false"},
    )
    ddl = "doc_id bigint, source string, body struct<parts: array<string>, none: string>"
    repaired = t.documents.select(repair_payload(payload).alias("payload"))
    p = payload_fields("payload", ddl)
    return repaired.select(p.alias("p"), F.json_object_keys(
        F.get_json_object("payload", "$.body")).alias("keys")).select(
        "p.doc_id",
        "p.source",
        F.md5(F.col("p.body.parts")[0]).alias("text_md5"),
        F.col("p.doc_id").alias("number_kept"),
        (F.array_contains("keys", "none") & F.col("p.body.none").isNull()).alias("null_kept"),
    )


@query(r"""
    SELECT doc_id,
           regexp_matches(text, '[^\x01-\x7f]') AND NOT regexp_matches(text, '[A-Za-z]') AS whole_text,
           regexp_matches(bare, '[^\x01-\x7f]') AND NOT regexp_matches(bare, '[A-Za-z]') AS letters_removed
    FROM (SELECT *, regexp_replace(text, '[A-Za-z]+', '', 'g') AS bare FROM documents)""")
def non_latin(t):
    """Non-ASCII text without a letter A-Z."""
    bare = F.regexp_replace("text", "[A-Za-z]+", "")
    return t.documents.select(
        "doc_id",
        is_non_latin("text").alias("whole_text"),
        is_non_latin(bare).alias("letters_removed"),
    )


@query(r"""
    WITH plain AS (
        SELECT page_id, html,
               regexp_replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'),
                                      '&quot;', '"'), '&amp;?', '&', 'g') AS unescaped
        FROM pages)
    SELECT page_id, md5(unescaped) AS html_md5,
           regexp_extract(unescaped, '<title>([^<]*)</title>', 1) AS title
    FROM plain""")
def html_unescape(t):
    """Character references of whole pages decoded once."""
    unescaped = t.pages.select("page_id", unescape_html("html").alias("html"))
    return unescaped.select(
        "page_id",
        F.md5("html").alias("html_md5"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
    )


@query("""
    SELECT p_partkey, array_to_string(string_split(lower(p_name), ' '), '|') AS tags,
           list_contains(string_split(p_name, ' '), 'widget') AS has_widget,
           TRUE AS empty_is_null
    FROM part""")
def tags_clean(t):
    """Tags trimmed and lower-cased; an empty list is NULL; any tag may match."""
    raw = F.transform(F.split("p_name", " "), lambda w: F.concat(F.lit("  "), F.upper(w), F.lit(" ")))
    tags = clean_tags(raw)
    return t.part.select(
        "p_partkey",
        F.array_join(tags, "|").alias("tags"),
        F.exists(tags, lambda tag: tag.rlike("(?i)\\bwidget\\b")).alias("has_widget"),
        clean_tags(F.filter(raw, lambda w: F.lit(False))).isNull().alias("empty_is_null"),
    )


@query("""
    SELECT DISTINCT md5(lower(trim(brand, ' '))) AS brand_id, brand
    FROM (SELECT p_brand AS brand FROM part UNION ALL SELECT upper(p_brand) FROM part)""")
def dim_surrogate(t):
    """Distinct names with a key that ignores case: two spellings, two rows, one key."""
    brands = t.part.select(F.col("p_brand").alias("brand"))
    shouted = t.part.select(F.upper("p_brand").alias("brand"))
    return dimension(brands.unionByName(shouted), "brand", "brand_id")


@query("""
    SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'building' THEN 'Construction'
                      ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS label
    FROM customer""")
def label_fallback(t):
    """Display label from a map, else the code in title case."""
    code = F.lower("c_mktsegment")
    return t.customer.select(
        "c_custkey", label_with_fallback(code, {"building": "Construction"}).alias("label")
    )


@query(rf"""
    WITH texts AS (
        SELECT doc_id, FALSE AS damaged, text, source FROM documents
        UNION ALL
        SELECT doc_id, TRUE, text, source FROM documents)
    SELECT doc_id, damaged,
           CASE WHEN damaged THEN NULL ELSE
               md5(coalesce(nullif(trim(regexp_replace(text, '[{SPACES}]+', ' ', 'g'), ' '), ''), '')) END AS clean_md5,
           CASE WHEN damaged THEN regexp_matches(text, '[^\x00-\x7F]')
                ELSE regexp_matches(text, '[\x{{C2}}-\x{{F4}}][\x{{80}}-\x{{BF}}]') END AS mojibake,
           regexp_matches(text, '[^\x01-\x7f]') AND NOT regexp_matches(text, '[A-Za-z]') AS non_latin,
           CASE WHEN damaged AND regexp_matches(text, '[^\x00-\x7F]') THEN NULL ELSE md5(text) END AS kept_md5,
           md5(lower(trim(source, ' '))) AS source_key
    FROM texts""")
def sql_macros(t):
    """The five text macros called from SQL, on texts as they are and on the same texts damaged."""
    register_sql_functions(t.spark)
    clean = t.documents.select("doc_id", F.lit(False).alias("damaged"), "text", "source")
    damaged = t.documents.select("doc_id", F.lit(True).alias("damaged"), corrupt(F.col("text")).alias("text"), "source")
    clean.unionByName(damaged).createOrReplaceTempView("documents_for_macros")
    return t.spark.sql("""
        SELECT doc_id, damaged,
               CASE WHEN NOT damaged THEN md5(coalesce(clean_text(text), '')) END AS clean_md5,
               is_mojibake(text) AS mojibake, is_non_latin(text) AS non_latin,
               md5(null_if_mojibake(text)) AS kept_md5, surrogate_key(source) AS source_key
        FROM documents_for_macros""")
