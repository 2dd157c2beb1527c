"""Landing rules, and raw postings derived from the driver's documents and pages.

``documents`` stand in for source A: each becomes a payload with damaged and
HTML-escaped text. ``pages`` stand in for source B.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode import fixed_values as fixed
from postlode.operators.landing import (
    in_categories,
    is_relevant,
    payload_fields,
    prefixed_key,
    truthy_text,
    with_payload,
)
from postlode.plans.ingest import SOURCE_A, SOURCE_B, keyed_batch
from queries.registry import AS_OF_EPOCH, corrupt, query

# --- postings of source A: documents -----------------------------------------

TITLES = {"en": "Data writer ", "fr": "Rédacteur ", "de": "Cloud Redakteur ", "es": "Escritor "}
PLACES = {
    "en": "London, UK, ", "fr": "Besançon, France", "de": "東京", "es": "México, Latin America,",
}


def _by_lang(values: dict[str, str]):
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("lang")]


def postings_a(t) -> DataFrame:
    payload = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("doc-"), "doc_id").alias("slug"),
        (F.lit(AS_OF_EPOCH) - (F.col("n_chars") % 30) * 86400).alias("epoch"),
        corrupt(F.concat(F.lit("Éditions "), "source", F.lit(" &amp; Co"))).alias("company"),
        corrupt(F.concat(_by_lang(TITLES), "source")).alias("position"),
        corrupt(_by_lang(PLACES)).alias("location"),
        F.array(F.upper("lang"), F.concat(F.lit(" "), "source", F.lit(" "))).alias("tags"),
        F.col("text").alias("description"),
        F.concat(F.lit("https://example.org/d/"), "doc_id").alias("url"),
        F.col("n_chars").alias("salary_min"),
        F.when(F.col("n_chars") > 5000, 0).otherwise(F.col("n_chars") * 2).alias("salary_max"),
    )
    return t.documents.select(F.to_json(payload).alias("payload"), F.col("doc_id").alias("position"))


def raw_a(t) -> DataFrame:
    """Source A's raw table as the upsert would leave it, last seen when posted."""
    batch = keyed_batch(SOURCE_A, postings_a(t))
    seen = F.timestamp_seconds(payload_fields("payload", "epoch bigint")["epoch"])
    return batch.select(
        "job_id", "payload", "source",
        (seen - F.expr("interval 1 day")).alias("first_seen_at"), seen.alias("last_seen_at"),
    )


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def _any_word(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


# The filter sees the text as it came, damage included; none of the keywords
# has a letter that damage could touch, so testing the clean text is the same.
POSTINGS_A_SQL = f"""
    SELECT 'remoteok_' || doc_id AS job_id, 'remoteok' AS source,
           {_case('lang', TITLES)} || source AS title,
           'Éditions ' || source || ' & Co' AS company_name,
           {_case('lang', PLACES)} AS raw_location,
           [lower(lang), source] AS tags, text AS description,
           'https://example.org/d/' || doc_id AS posting_url,
           nullif(n_chars, 0) AS salary_min,
           nullif(CASE WHEN n_chars > 5000 THEN 0 ELSE n_chars * 2 END, 0) AS salary_max,
           make_timestamp(({AS_OF_EPOCH} - (n_chars % 30) * 86400) * 1000000) AS posted_at,
           NULL AS source_category,
           make_timestamp(({AS_OF_EPOCH} - (n_chars % 30) * 86400) * 1000000) AS last_seen_at
    FROM (SELECT *, lower({_case('lang', TITLES)} || source || ' ' || upper(lang) || '  ' || source
                          || '  ' || text) AS haystack FROM documents)
    WHERE {_any_word('haystack', fixed.RELEVANT_KEYWORDS)}"""

# --- postings of source B: pages ---------------------------------------------

CATEGORIES = {
    "en": "Software Development", "fr": "Data and Analytics", "de": "DevOps / Sysadmin",
}
REGIONS_B = {"en": "Europe, USA , ", "fr": "EMEA", "de": "  ", "es": "New Mexico"}
LANG_OF_URL = r"^https?://[^/]+/([a-z]+)/"
HOST_OF_URL = r"^https?://([^/]+)"
TITLE_OF_PAGE = "<title>([^<]*)</title>"


def postings_b(t) -> DataFrame:
    pages = t.pages.withColumn("lang", F.regexp_extract("url", LANG_OF_URL, 1))
    payload = F.struct(
        (F.col("page_id") + 1).alias("id"),  # the number 0 is no id
        "url",
        F.regexp_extract("html", TITLE_OF_PAGE, 1).alias("title"),
        F.regexp_extract("url", HOST_OF_URL, 1).alias("company_name"),
        F.coalesce(_by_lang(CATEGORIES), F.lit("Writing")).alias("category"),
        F.array().cast("array<string>").alias("tags"),
        F.date_format(
            F.timestamp_seconds(F.lit(AS_OF_EPOCH) - (F.col("page_id") % 30) * 86400),
            "yyyy-MM-dd'T'HH:mm:ss",
        ).alias("publication_date"),
        _by_lang(REGIONS_B).alias("candidate_required_location"),
        F.lit("").alias("salary"),
        F.col("html").alias("description"),
    )
    return pages.select(F.to_json(payload).alias("payload"), F.col("page_id").alias("position"))


def raw_b(t) -> DataFrame:
    batch = keyed_batch(SOURCE_B, postings_b(t))
    seen = payload_fields("payload", "publication_date string")["publication_date"].cast("timestamp")
    return batch.select(
        "job_id", "payload", "source",
        (seen - F.expr("interval 1 day")).alias("first_seen_at"), seen.alias("last_seen_at"),
    )


POSTINGS_B_SQL = f"""
    SELECT 'remotive_' || (page_id + 1) AS job_id, 'remotive' AS source,
           regexp_extract(html, '{TITLE_OF_PAGE}', 1) AS title,
           regexp_extract(url, '{HOST_OF_URL}', 1) AS company_name,
           {_case('lang', REGIONS_B)} AS raw_location,
           NULL::VARCHAR[] AS tags, html AS description, url AS posting_url,
           NULL::BIGINT AS salary_min, NULL::BIGINT AS salary_max,
           make_timestamp(({AS_OF_EPOCH} - (page_id % 30) * 86400) * 1000000) AS posted_at,
           {_case('lang', CATEGORIES)} AS source_category,
           make_timestamp(({AS_OF_EPOCH} - (page_id % 30) * 86400) * 1000000) AS last_seen_at
    FROM (SELECT *, regexp_extract(url, '{LANG_OF_URL}', 1) AS lang FROM pages)
    WHERE lang IN ('en', 'fr', 'de')"""


# --- queries -----------------------------------------------------------------


@query(f"""
    SELECT doc_id, {_any_word("lower(source || ' ' || lang || ' ' || source || ' ' || text)",
                              fixed.RELEVANT_KEYWORDS)} AS relevant
    FROM documents""")
def relevance_substring(t):
    """Any keyword as a substring of title, tags and description joined by spaces."""
    return t.documents.select(
        "doc_id", is_relevant("source", "text", F.array("lang", "source")).alias("relevant")
    )


@query("""
    SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'purchase')""")
def category_allow_list(t):
    """Only the allowed categories; a missing one is out."""
    category = F.nullif(F.col("event_type"), F.lit("error"))
    return t.events.where(in_categories(category, ["view", "purchase", "error"])).select(
        "event_id", "event_type"
    )


@query("""
    SELECT event_id,
           'evt_' || CASE event_type WHEN 'error' THEN '0' WHEN 'purchase' THEN event_id::VARCHAR
                     ELSE 'u' || user_id END AS job_id
    FROM events""")
def prefixed_key_events(t):
    """The id, else the slug: null, "" and the number 0 count as missing, the text "0" does not."""
    native = (
        F.when(F.col("event_type") == "view", "null")
        .when(F.col("event_type") == "click", '""')
        .when(F.col("event_type") == "signup", "0")
        .when(F.col("event_type") == "error", '"0"')
        .otherwise(F.col("event_id").cast("string"))
    )
    payload = F.concat(F.lit('{"id": '), native, F.lit(', "slug": "u'), "user_id", F.lit('"}'))
    events = t.events.select("event_id", payload.alias("payload"))
    key = prefixed_key(
        "evt", truthy_text("payload", "id"), truthy_text("payload", "slug"), missing="no key"
    )
    return events.select("event_id", key.alias("job_id"))


@query(f"""
    SELECT job_id, md5(title) AS title_md5, md5(company_name) AS company_md5,
           md5(raw_location) AS location_md5, md5(description) AS description_md5
    FROM ({POSTINGS_A_SQL})""")
def landed_postings_a(t):
    """Filter, key, repair and unescape of an array source's payloads."""
    fields = payload_fields("payload", "position string, company string, location string, description string")
    return keyed_batch(SOURCE_A, postings_a(t)).select("job_id", fields.alias("p")).select(
        "job_id",
        F.md5("p.position").alias("title_md5"),
        F.md5("p.company").alias("company_md5"),
        F.md5("p.location").alias("location_md5"),
        F.md5("p.description").alias("description_md5"),
    )


@query(f"""
    SELECT job_id, source_category AS category, md5(description) AS description_md5
    FROM ({POSTINGS_B_SQL})""")
def landed_postings_b(t):
    """Category filter and key of an envelope source's payloads; text is left as it came."""
    fields = payload_fields("payload", "category string, description string")
    return keyed_batch(SOURCE_B, postings_b(t)).select("job_id", fields.alias("p")).select(
        "job_id", "p.category", F.md5("p.description").alias("description_md5")
    )


@query(f"""
    SELECT 'remoteok' AS source, (SELECT count(*) FROM documents) AS records_fetched,
           (SELECT count(*) FROM ({POSTINGS_A_SQL})) AS records_upserted
    UNION ALL
    SELECT 'remotive', (SELECT count(*) FROM pages), (SELECT count(*) FROM ({POSTINGS_B_SQL}))""")
def landing_counts(t):
    """What the run log records: postings read before the filter, and postings kept."""
    return _counts(SOURCE_A, postings_a(t)).unionByName(_counts(SOURCE_B, postings_b(t)))


def _counts(spec, postings):
    return with_payload(postings, spec.fields).agg(
        F.lit(spec.name).alias("source"),
        F.count(F.lit(1)).alias("records_fetched"),
        F.count_if(spec.keep()).alias("records_upserted"),
    )
