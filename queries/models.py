"""Staging, unification, the star and the demand marts."""

from pyspark.sql import functions as F

from postlode import fixed_values as fixed
from postlode import schemas
from postlode.functions.text import surrogate_key
from postlode.operators import marts
from postlode.operators.staging import salary, stage_source_a, stage_source_b
from postlode.operators.tagging import region_rows, tag
from postlode.operators.unify import in_scope, translate_location, unify, union_sources
from postlode.sources.seeds import seed_table
from queries.landing import POSTINGS_A_SQL, POSTINGS_B_SQL, raw_a, raw_b
from queries.registry import (
    AS_OF_SQL,
    PARAMS,
    NOT_WORD,
    as_double,
    keywords_found_sql,
    micros,
    query,
    share_sql,
    values_sql,
)

# Words of the documents, in the shape of the skill seed.
SKILLS = [
    ("The", "en", "the"), ("Of the", "en", "of the"), ("In", "en", "in"), ("Entive", "en", "ent"),
    ("And", "en", "and"), ("That it", "en", "that it"), ("Der", "de", "der"), ("Für", "de", "für"),
    ("Über", "de", "über"), ("Und die", "de", "und die"), ("Que", "fr", "que"), ("Les", "fr", "les"),
    ("Ou", "fr", "ou"), ("Ré", "fr", "ré"), ("Ion", "es", "ion"), ("Src7", "src", "src7"),
    ("En", "mixed", "en"), ("Ai", "mixed", "ai"), ("Nothing", "none", "zzzyx"),
]
SKILL_IDS_SQL = f"""
    SELECT md5(lower(trim(n, ' '))) AS skill_id, n AS skill_name, c AS category, k AS match_keyword
    FROM {values_sql(SKILLS)} AS s(n, c, k)"""
REGIONS_SQL = f"SELECT k, region FROM {values_sql(fixed.REGION_KEYWORDS)} AS r(k, region)"
SKILL_WORDS = [keyword for _, _, keyword in SKILLS]
REGION_WORDS = sorted({keyword for keyword, _ in fixed.REGION_KEYWORDS})
# (location in another script, English): only one of the two scripts is translated.
TRANSLATIONS = [("東京", "Tokyo, Japan")]


def skills(t):
    return marts.dim_skill(seed_table(t.spark, SKILLS, schemas.SKILL_SEED))


def regions(t):
    return seed_table(t.spark, fixed.REGION_KEYWORDS, schemas.REGION_SEED)


def translations(t):
    return seed_table(t.spark, TRANSLATIONS, schemas.TRANSLATION_SEED)


def unified(t):
    return unify([stage_source_a(raw_a(t)), stage_source_b(raw_b(t))], translations(t))


# --- staging -----------------------------------------------------------------


@query("""
    SELECT event_id, props->>'k' AS k_text, nullif(props->>'k', '0')::DOUBLE AS k_number,
           epoch_us(make_timestamp((1700000000 + (props->>'k')::BIGINT) * 1000000)) AS at_us,
           (props->>'missing') IS NULL AS missing_is_null
    FROM events""")
def json_flatten(t):
    """JSON fields as text, zero as NULL, text to number, epoch to timestamp."""
    p = F.from_json("props", "k string, missing string", {"mode": "FAILFAST"})
    return t.events.select("event_id", p.alias("p")).select(
        "event_id",
        F.col("p.k").alias("k_text"),
        salary(F.col("p.k")).cast("double").alias("k_number"),
        micros(F.timestamp_seconds(F.col("p.k").cast("bigint") + 1700000000)).alias("at_us"),
        F.col("p.missing").isNull().alias("missing_is_null"),
    )


def _staged_sql(postings: str) -> str:
    return f"""
        SELECT job_id, source, title, company_name, nullif(trim(raw_location, ' '), '') AS location,
               TRUE AS is_remote, array_to_string(tags, '|') AS tags, md5(description) AS description_md5,
               posting_url, salary_min::DOUBLE AS salary_min, salary_max::DOUBLE AS salary_max,
               epoch_us(posted_at) AS posted_us, source_category::VARCHAR AS source_category,
               epoch_us(last_seen_at - INTERVAL 1 DAY) AS first_seen_us, epoch_us(last_seen_at) AS last_seen_us
        FROM ({postings})"""


def _staged_view(staged):
    return staged.select(
        "job_id", "source", "title", "company_name", "location", "is_remote",
        F.array_join("tags", "|").alias("tags"),
        F.md5("description").alias("description_md5"),
        "posting_url",
        F.col("salary_min").cast("double").alias("salary_min"),
        F.col("salary_max").cast("double").alias("salary_max"),
        micros("posted_at").alias("posted_us"),
        "source_category",
        micros("first_seen_at").alias("first_seen_us"),
        micros("last_seen_at").alias("last_seen_us"),
    )


@query(_staged_sql(POSTINGS_A_SQL))
def staged_postings_a(t):
    """An array source's payloads on the common shape."""
    return _staged_view(stage_source_a(raw_a(t)))


@query(_staged_sql(POSTINGS_B_SQL))
def staged_postings_b(t):
    """An envelope source's payloads on the common shape."""
    return _staged_view(stage_source_b(raw_b(t)))


# --- unification -------------------------------------------------------------


@query("""
    SELECT c_custkey AS party_key, c_name AS party_name, c_acctbal AS balance, 'customer' AS source FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""")
def union_common_shape(t):
    """Sources on one shape stacked by column name, duplicates kept."""
    customers = t.customer.select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"),
        F.col("c_acctbal").alias("balance"), F.lit("customer").alias("source"),
    )
    suppliers = t.supplier.select(
        F.lit("supplier").alias("source"), F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("party_name"), F.col("s_suppkey").alias("party_key"),
    )
    return union_sources([customers, suppliers])


@query("""
    SELECT p_partkey, p_name, p_type FROM part
    WHERE p_type IN ('LARGE', 'SMALL') OR regexp_matches(p_name, '(?i)GEAR|idge|bol')""")
def scope_predicate(t):
    """An allowed category, or a word in the title when the category is missing or another."""
    category = F.nullif(F.col("p_type"), F.lit("PROMO"))
    keep = in_scope(category, F.col("p_name"), ["LARGE", "SMALL"], "GEAR|idge|bol")
    return t.part.where(keep).select("p_partkey", "p_name", "p_type")


@query(f"""
    WITH placed AS (
        SELECT c_custkey, CASE n_regionkey WHEN 2 THEN translate(n_name, 'NATIO', 'ΝΑΤΙΟ')
                          WHEN 3 THEN NULL ELSE n_name END AS place
        FROM customer JOIN nation ON c_nationkey = n_nationkey),
    sources AS (SELECT c_custkey, regexp_replace(place, '[A-Z_]+$', '') AS source_location FROM placed)
    SELECT c_custkey, s.source_location,
           CASE WHEN t.en IS NOT NULL THEN t.en
                WHEN regexp_matches(s.source_location, '[^\\x01-\\x7f]')
                     AND NOT regexp_matches(s.source_location, '[A-Za-z]') THEN NULL
                ELSE s.source_location END AS location
    FROM sources s LEFT JOIN (VALUES ('ΝΑΤΙΟΝ_2', 'Nation Two'), ('ΝΑΤΙΟΝ_12', 'Nation Twelve')) AS t(src, en)
         ON t.src = s.source_location""")
def translate_locations(t):
    """Translated where known, NULL for other foreign scripts, else the text itself."""
    place = (
        F.when(F.col("n_regionkey") == 2, F.translate("n_name", "NATIO", "ΝΑΤΙΟ"))
        .when(F.col("n_regionkey") != 3, F.col("n_name"))
    )
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", place.alias("source_location")
    )
    known = seed_table(
        t.spark, [("ΝΑΤΙΟΝ_2", "Nation Two"), ("ΝΑΤΙΟΝ_12", "Nation Twelve")],
        schemas.TRANSLATION_SEED,
    )
    return translate_location(customers, known).select("c_custkey", "source_location", "location")


UNIFIED_SQL = f"""
    SELECT job_id, source, trim(title, ' ') AS title,
           nullif(trim(regexp_replace(company_name, '\\s+', ' ', 'g'), ' '), '') AS company_name,
           coalesce(tr.en, CASE WHEN NOT (regexp_matches(source_location, '[^\\x01-\\x7f]')
                                AND NOT regexp_matches(source_location, '[A-Za-z]'))
                           THEN source_location END) AS location,
           source_location, tags, description, posting_url, salary_min, salary_max, posted_at,
           source_category, last_seen_at
    FROM (SELECT *, nullif(trim(regexp_replace(regexp_replace(nullif(trim(raw_location, ' '), ''),
                    '[,\\s]+$', ''), '\\s+', ' ', 'g'), ' '), '') AS source_location
          FROM (({POSTINGS_A_SQL}) UNION ALL ({POSTINGS_B_SQL})))
    LEFT JOIN {values_sql(TRANSLATIONS)} AS tr(src, en) ON tr.src = source_location
    WHERE title IS NOT NULL
      AND (coalesce(source_category IN ('Software Development', 'Data and Analytics', 'DevOps / Sysadmin'), FALSE)
           OR regexp_matches(title, '(?i){fixed.TITLE_PATTERN}'))"""
IS_ACTIVE_SQL = f"last_seen_at >= {AS_OF_SQL} - INTERVAL 14 DAY"


@query(f"""
    SELECT job_id, source, title, company_name, location, source_location, TRUE AS is_remote,
           array_to_string(tags, '|') AS tags, md5(description) AS description_md5, posting_url,
           source_category::VARCHAR AS source_category
    FROM ({UNIFIED_SQL})""")
def unified_postings(t):
    """Both sources, relevant postings only, clean and translated."""
    return unified(t).select(
        "job_id", "source", "title", "company_name", "location", "source_location", "is_remote",
        F.array_join("tags", "|").alias("tags"), F.md5("description").alias("description_md5"),
        "posting_url", "source_category",
    )


# --- the star ----------------------------------------------------------------


@query(f"""
    SELECT DISTINCT md5(lower(trim(company_name, ' '))) AS company_id, company_name
    FROM ({UNIFIED_SQL}) WHERE company_name IS NOT NULL""")
def dim_company(t):
    """Distinct employers of all sources."""
    return marts.dim_company(unified(t))


@query("""
    SELECT d.doc_id, d.source, c.source_key, c.longest, d.n_chars = c.longest AS is_longest
    FROM documents d LEFT JOIN (
        SELECT source, md5(lower(trim(source, ' '))) AS source_key, max(n_chars) AS longest
        FROM documents WHERE source IS NOT NULL GROUP BY source) c ON d.source = c.source""")
def fact_of_hot_names(t):
    """Every document with its source's dimension row; sources that hold much of the table are split."""
    dim = t.documents.where("source is not null").groupBy("source").agg(
        surrogate_key("source").alias("source_key"), F.max("n_chars").alias("longest")
    )
    return marts.attach_dimension(t.documents.select("doc_id", "source", "n_chars"), dim, "source", "doc_id").select(
        "doc_id", "source", "source_key", "longest", (F.col("n_chars") == F.col("longest")).alias("is_longest")
    )


@query("""
    SELECT md5(lower(trim(p_name || ' ' || p_partkey, ' '))) AS skill_id, p_name || ' ' || p_partkey AS skill_name,
           p_type AS category, lower(p_name) AS match_keyword
    FROM part""")
def dim_skill(t):
    """A taxonomy with its keys: parts as skills."""
    seed = t.part.select(
        F.concat_ws(" ", "p_name", "p_partkey").alias("skill_name"),
        F.col("p_type").alias("category"),
        F.lower("p_name").alias("match_keyword"),
    )
    return marts.dim_skill(seed)


@query(f"""
    SELECT job_id, md5(lower(trim(company_name, ' '))) AS company_id, source, title, location,
           TRUE AS is_remote, salary_min::DOUBLE AS salary_min, salary_max::DOUBLE AS salary_max,
           epoch_us(posted_at) AS posted_us, posting_url,
           epoch_us(last_seen_at - INTERVAL 1 DAY) AS first_seen_us,
           epoch_us(last_seen_at) AS last_seen_us, {IS_ACTIVE_SQL} AS is_active
    FROM ({UNIFIED_SQL})""")
def fact_postings(t):
    """One row per posting with its company key and activity."""
    return marts.fact_postings(unified(t), PARAMS).select(
        "job_id", "company_id", "source", "title", "location", "is_remote",
        F.col("salary_min").cast("double").alias("salary_min"),
        F.col("salary_max").cast("double").alias("salary_max"),
        micros("posted_at").alias("posted_us"), "posting_url",
        micros("first_seen_at").alias("first_seen_us"),
        micros("last_seen_at").alias("last_seen_us"), "is_active",
    )


ORDERS_AS_OF_SQL = "TIMESTAMP '2001-07-01 00:00:00'"


@query(f"""
    WITH names AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS name FROM customer),
         dim AS (SELECT DISTINCT md5(lower(trim(name, ' '))) AS company_id, name FROM names WHERE name IS NOT NULL)
    SELECT o_orderkey, d.company_id, o_orderdate >= {ORDERS_AS_OF_SQL} - INTERVAL 14 DAY AS is_active
    FROM orders JOIN names ON o_custkey = c_custkey LEFT JOIN dim d ON d.name = names.name""")
def fact_active_flag(t):
    """Left join to a dimension by exact name, NULL names unmatched, and the activity window."""
    from datetime import datetime, timezone

    from postlode.params import Params

    params = Params(datetime(2001, 7, 1, tzinfo=timezone.utc))
    name = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name")
    names = t.customer.select("c_custkey", name)
    orders = t.orders.withColumn("last_seen_at", F.col("o_orderdate")).join(
        names, F.col("o_custkey") == F.col("c_custkey")
    )
    dim = marts.dimension(names, "name", "company_id")
    fact = marts.with_activity_flag(marts.attach_dimension(orders, dim, "name"), params)
    return fact.select("o_orderkey", "company_id", "is_active")


# --- bridges -----------------------------------------------------------------


def documents_as_postings(t):
    """Documents with an activity that depends on their length."""
    return t.documents.select(
        F.col("doc_id").alias("job_id"), F.col("text").alias("description"),
        F.array("source", "lang").alias("tags"),
        (F.col("n_chars") % 30 <= 14).alias("is_active"),
    )


PAIRS_SQL = f"""
    SELECT job_id, skill_id, is_active
    FROM (SELECT doc_id AS job_id, n_chars % 30 <= 14 AS is_active,
                 unnest({keywords_found_sql(['text', 'source', 'lang'], SKILL_WORDS)}) AS match_keyword
          FROM documents) JOIN ({SKILL_IDS_SQL}) USING (match_keyword)"""


@query(f"SELECT job_id, skill_id FROM ({PAIRS_SQL})")
def bridge_keyword(t):
    """(document, skill) pairs: keyword as a whole word in the text or a tag, any case."""
    return marts.bridge_job_skill(documents_as_postings(t), skills(t)).select("job_id", "skill_id")


@query(rf"""
    WITH words AS (SELECT DISTINCT w FROM (
            SELECT unnest(regexp_split_to_array(lower(text), '{NOT_WORD}+')) AS w FROM benchmark) WHERE w <> ''),
         seen AS (SELECT DISTINCT doc_id, w FROM (
            SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{NOT_WORD}+')) AS w FROM documents))
    SELECT w AS keyword, count(*) AS n_documents FROM seen JOIN words USING (w) GROUP BY w""")
def bridge_large_taxonomy(t):
    """Documents tagged with every word of the benchmark texts, a taxonomy of any size."""
    words = t.benchmark.select(F.explode(F.split(F.lower("text"), "(?U)\\W+")).alias("keyword"))
    taxonomy = words.where("keyword <> ''").distinct()
    pairs = tag(
        t.documents, taxonomy.withColumn("label", F.col("keyword")), text=["text"], label="label",
        keyword="keyword", key="doc_id",
    )
    return pairs.groupBy(F.col("label").alias("keyword")).agg(
        F.count(F.lit(1)).alias("n_documents")
    )


@query(rf"""
    WITH words AS (SELECT DISTINCT w FROM (
            SELECT unnest(regexp_split_to_array(lower(text), '{NOT_WORD}+')) AS w FROM benchmark) WHERE w <> ''),
         places AS (SELECT doc_id, n_chars % 3 = 0 AS is_named, source || ' ' || text AS place FROM documents),
         seen AS (SELECT DISTINCT doc_id, w[1] AS region FROM (
            SELECT doc_id, unnest(regexp_split_to_array(lower(place), '{NOT_WORD}+')) AS w FROM places WHERE is_named)
            JOIN words USING (w))
    SELECT region, count(*) AS n_documents FROM (
        SELECT doc_id, region FROM seen
        UNION ALL
        SELECT doc_id, 'Unspecified' FROM places WHERE doc_id NOT IN (SELECT doc_id FROM seen))
    GROUP BY region""")
def bridge_region_large(t):
    """Regions by a taxonomy of hundreds of keywords: each once per row, and the default without any.

    A region is a keyword's first letter; two thirds of the rows have no text to search.
    """
    words = t.benchmark.select(F.explode(F.split(F.lower("text"), "(?U)\\W+")).alias("match_keyword"))
    regions_of_words = words.where("match_keyword <> ''").distinct().withColumn(
        "region", F.substring("match_keyword", 1, 1)
    )
    place = F.when(F.col("n_chars") % 3 == 0, F.concat_ws(" ", "source", "text"))
    places = t.documents.select(F.col("doc_id").alias("job_id"), place.alias("location"))
    pairs = region_rows(places, regions_of_words, default=fixed.UNSPECIFIED)
    return pairs.groupBy("region").agg(F.count(F.lit(1)).alias("n_documents"))


# Rows without any keyword beside the documents: their keys and places.
UNNAMED_PLACES_SQL = "VALUES (-1, NULL), (-2, ''), (-3, '?!')"


@query(rf"""
    WITH words AS (SELECT DISTINCT w FROM (
            SELECT unnest(regexp_split_to_array(lower(text), '{NOT_WORD}+')) AS w FROM benchmark) WHERE w <> ''),
         places(job_id, place) AS (
            SELECT doc_id, concat_ws(' ', source, text) FROM documents UNION ALL {UNNAMED_PLACES_SQL}),
         seen AS (SELECT DISTINCT job_id, w[1] AS region FROM (
            SELECT job_id, unnest(regexp_split_to_array(lower(place), '{NOT_WORD}+')) AS w FROM places)
            JOIN words USING (w))
    SELECT region, count(*) AS n_documents FROM (
        SELECT job_id, region FROM seen
        UNION ALL
        SELECT job_id, 'Unspecified' FROM places WHERE job_id NOT IN (SELECT job_id FROM seen))
    GROUP BY region""")
def bridge_region_every(t):
    """`bridge_region_large` with the source and text of every document searched.

    The default comes from rows that name none: a few generated ones, and documents without a keyword.
    """
    words = t.benchmark.select(F.explode(F.split(F.lower("text"), "(?U)\\W+")).alias("match_keyword"))
    regions_of_words = words.where("match_keyword <> ''").distinct().withColumn(
        "region", F.substring("match_keyword", 1, 1)
    )
    unnamed = t.spark.sql(f"SELECT CAST(id AS BIGINT) AS job_id, location FROM {UNNAMED_PLACES_SQL} AS v(id, location)")
    places = t.documents.select(
        F.col("doc_id").cast("bigint").alias("job_id"), F.concat_ws(" ", "source", "text").alias("location")
    ).unionByName(unnamed)
    pairs = region_rows(places, regions_of_words, default=fixed.UNSPECIFIED)
    return pairs.groupBy("region").agg(F.count(F.lit(1)).alias("n_documents"))


# The customer's market as its location: some name a region, one is NULL.
PLACES_SQL = """
    SELECT c_custkey AS job_id, c_acctbal >= 0 AS is_active,
           CASE r_name WHEN 'MIDDLE EAST' THEN NULL
                WHEN 'ASIA' THEN 'Remote (' || r_name || ', Emea)'
                WHEN 'AFRICA' THEN 'africa / EMEA, us' ELSE r_name END AS location
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
REGION_PAIRS_SQL = f"""
    WITH places AS ({PLACES_SQL}),
         found AS (SELECT job_id, is_active, unnest({keywords_found_sql(['location'], REGION_WORDS)}) AS k
                   FROM places),
         matched AS (SELECT DISTINCT job_id, is_active, region FROM found JOIN ({REGIONS_SQL}) USING (k))
    SELECT * FROM matched
    UNION ALL
    SELECT job_id, is_active, 'Unspecified' FROM places WHERE job_id NOT IN (SELECT job_id FROM matched)"""


def customer_places(t):
    r_name = F.col("r_name")
    location = (
        F.when(r_name == "MIDDLE EAST", None)
        .when(r_name == "ASIA", F.concat(F.lit("Remote ("), r_name, F.lit(", Emea)")))
        .when(r_name == "AFRICA", "africa / EMEA, us")
        .otherwise(r_name)
    )
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("job_id"), location.alias("location"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
        )
    )


@query(f"SELECT job_id, region FROM ({REGION_PAIRS_SQL})")
def bridge_region(t):
    """(customer, region) pairs; one row per region, 'Unspecified' where none matches."""
    return region_rows(customer_places(t), regions(t), default=fixed.UNSPECIFIED)


# --- demand ------------------------------------------------------------------

SKILL_DEMAND_SQL = f"""
    WITH counts AS (SELECT skill_id, count(DISTINCT job_id) FILTER (WHERE is_active) AS a,
                           count(DISTINCT job_id) AS n FROM ({PAIRS_SQL}) GROUP BY skill_id),
         totals AS (SELECT count(*) FILTER (WHERE n_chars % 30 <= 14) AS ta, count(*) AS tn FROM documents)
    SELECT s.skill_id, skill_name, category, coalesce(a, 0) AS postings_count,
           {share_sql('coalesce(a, 0)', 'ta', 2)} AS pct_of_active_postings,
           coalesce(n, 0) AS all_time_postings_count,
           {share_sql('coalesce(n, 0)', 'tn', 2)} AS pct_of_all_postings
    FROM ({SKILL_IDS_SQL}) s LEFT JOIN counts USING (skill_id), totals"""


def document_demand(t):
    postings = documents_as_postings(t)
    return marts.skill_demand(skills(t), marts.bridge_job_skill(postings, skills(t)), postings)


def _demand_view(demand):
    return demand.withColumns(as_double("pct_of_active_postings", "pct_of_all_postings"))


@query(SKILL_DEMAND_SQL)
def skill_demand(t):
    """Documents per skill, active and all, with shares; skills without a match have 0."""
    return _demand_view(document_demand(t))


@query(SKILL_DEMAND_SQL)
def skill_demand_joined(t):
    """The same from a bridge stored without activity, which is joined from the fact."""
    postings = documents_as_postings(t)
    bridge = marts.bridge_job_skill(postings.drop("is_active"), skills(t))
    pairs = marts.with_activity(bridge, postings)
    return _demand_view(marts.skill_demand(skills(t), pairs, postings))


@query(f"""
    WITH pairs AS (SELECT l_orderkey, p_brand, o_orderstatus = 'O' AS is_active
                   FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
         counts AS (SELECT p_brand, count(DISTINCT l_orderkey) FILTER (WHERE is_active) AS a,
                           count(DISTINCT l_orderkey) AS n FROM pairs GROUP BY p_brand),
         totals AS (SELECT count(*) FILTER (WHERE o_orderstatus = 'O') AS ta, count(*) AS tn FROM orders)
    SELECT md5(lower(p_brand)) AS skill_id, p_brand AS skill_name, 'brand' AS category, a AS postings_count,
           {share_sql('a', 'ta', 2)} AS pct_of_active_postings, n AS all_time_postings_count,
           {share_sql('n', 'tn', 2)} AS pct_of_all_postings
    FROM counts, totals""")
def distinct_filtered_counts(t):
    """Distinct orders per brand, open and all, from line items that repeat a pair."""
    parts = t.part.select("p_partkey", surrogate_key("p_brand").alias("skill_id"))
    lines = t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("job_id"), "skill_id"
    )
    orders = t.orders.select(
        F.col("o_orderkey").alias("job_id"), (F.col("o_orderstatus") == "O").alias("is_active")
    )
    brands = marts.dimension(t.part, "p_brand", "skill_id").select(
        "skill_id", F.col("p_brand").alias("skill_name"), F.lit("brand").alias("category")
    )
    return _demand_view(marts.skill_demand_distinct(brands, marts.with_activity(lines, orders), orders))


REGION_DEMAND_SQL = f"""
    WITH pairs AS ({REGION_PAIRS_SQL}),
         total AS (SELECT count(*) FILTER (WHERE is_active) AS n FROM ({PLACES_SQL})),
         counts AS (SELECT region, count(*) AS c FROM pairs WHERE is_active GROUP BY region)
    SELECT region, c AS postings_count, {share_sql('c', 'n', 1)} AS pct_of_active_postings
    FROM counts, total"""


def customer_region_demand(t):
    places = customer_places(t)
    pairs = region_rows(places, regions(t), carry=["is_active"], default=fixed.UNSPECIFIED)
    return marts.region_demand(pairs, places)


@query(REGION_DEMAND_SQL)
def region_demand(t):
    """Active customers per region and their share; regions with none are absent."""
    return customer_region_demand(t).withColumns(as_double("pct_of_active_postings"))


# --- from payload to mart ----------------------------------------------------


@query(f"""
    WITH postings AS (SELECT *, {IS_ACTIVE_SQL} AS is_active FROM ({UNIFIED_SQL})),
         found AS (SELECT job_id, is_active, unnest({keywords_found_sql(['description', 'tags[1]', 'tags[2]'],
                                                                        SKILL_WORDS)}) AS match_keyword
                   FROM postings),
         pairs AS (SELECT job_id, is_active, skill_id FROM found JOIN ({SKILL_IDS_SQL}) USING (match_keyword)),
         counts AS (SELECT skill_id, count(*) FILTER (WHERE is_active) AS a, count(*) AS n
                    FROM pairs GROUP BY skill_id),
         totals AS (SELECT count(*) FILTER (WHERE is_active) AS ta, count(*) AS tn FROM postings)
    SELECT s.skill_id, skill_name, category, coalesce(a, 0) AS postings_count,
           {share_sql('coalesce(a, 0)', 'ta', 2)} AS pct_of_active_postings,
           coalesce(n, 0) AS all_time_postings_count,
           {share_sql('coalesce(n, 0)', 'tn', 2)} AS pct_of_all_postings
    FROM ({SKILL_IDS_SQL}) s LEFT JOIN counts USING (skill_id), totals""")
def posting_skill_demand(t):
    """From raw payloads of two sources to skill demand."""
    flagged = marts.with_activity_flag(unified(t), PARAMS)
    postings = flagged.select("job_id", "description", "tags", "is_active")
    pairs = marts.bridge_job_skill(postings, skills(t))
    return _demand_view(marts.skill_demand(skills(t), pairs, postings))


@query(f"""
    WITH postings AS (SELECT *, {IS_ACTIVE_SQL} AS is_active FROM ({UNIFIED_SQL})),
         found AS (SELECT job_id, is_active, unnest({keywords_found_sql(['location'], REGION_WORDS)}) AS k
                   FROM postings),
         matched AS (SELECT DISTINCT job_id, is_active, region FROM found JOIN ({REGIONS_SQL}) USING (k)),
         pairs AS (SELECT * FROM matched UNION ALL
                   SELECT job_id, is_active, 'Unspecified' FROM postings
                   WHERE job_id NOT IN (SELECT job_id FROM matched)),
         total AS (SELECT count(*) FILTER (WHERE is_active) AS n FROM postings),
         counts AS (SELECT region, count(*) AS c FROM pairs WHERE is_active GROUP BY region)
    SELECT region, c AS postings_count, {share_sql('c', 'n', 1)} AS pct_of_active_postings
    FROM counts, total""")
def posting_region_demand(t):
    """From raw payloads of two sources to demand by region."""
    fact = marts.fact_postings(unified(t), PARAMS).select("job_id", "location", "is_active")
    pairs = marts.bridge_job_region(fact, regions(t), PARAMS)
    return marts.region_demand(pairs, fact).withColumns(as_double("pct_of_active_postings"))
