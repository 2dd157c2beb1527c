"""Values that fix the results: word lists, lookup tables, patterns and limits.

Everything in this module is a fixed value. Changing one changes which postings
are kept, how they are tagged, or when they age out.
"""

# --- fixed values: which postings are relevant -------------------------------

# Plain substrings looked for in title + tags + description, lower-cased.
RELEVANT_KEYWORDS = [
    "data", "engineer", "engineering", "analytics", "analyst", "python",
    "sql", "etl", "elt", "warehouse", "pipeline", "airflow", "dbt", "spark",
    "kafka", "cloud", "aws", "gcp", "azure", "machine learning", "ml ",
    "backend", "software", "devops", "platform",
]

# Category labels in scope, for sources that classify their own postings.
TECH_CATEGORIES = ["Software Development", "Data and Analytics", "DevOps / Sysadmin"]

# Words looked for in a title, any case, when no category decides.
TITLE_PATTERN = (
    "data|software|developer|analytics|python|sql|etl|airflow|dbt|spark|devops"
    "|machine learning|cloud|backend"
)

# --- fixed values: text patterns ---------------------------------------------

# UTF-8 bytes read as Latin-1 leave runs of these characters ...
LATIN1_RUN = r"[\u0080-\u00FF]+"
# ... which always hold a lead byte followed by a continuation byte.
MOJIBAKE_SIGNATURE = r"[\u00C2-\u00F4][\u0080-\u00BF]"
REPAIR_PASSES = 3

# White space collapsed by clean_text: ASCII and the breaking Unicode spaces.
SPACES = r" \t\n\x0B\f\r\u1680\u2000-\u2006\u2008-\u200A\u2028\u2029\u205F\u3000"
WHITESPACE = f"[{SPACES}]"
TRAILING_SEPARATORS = f"[,{SPACES}]+\\z"
NON_ASCII = r"[^\x01-\x7f]"
LATIN_LETTER = "[A-Za-z]"

# Locations that name no place, so no region is expected of them.
PLACELESS_LOCATION = r"(?i)^remot[eo]\z"

# --- fixed values: sources, labels and limits --------------------------------

SOURCE_A = "remoteok"   # top-level array of postings, HTML-escaped plain fields
SOURCE_B = "remotive"   # envelope with a "jobs" array and its own categories
HTML_ESCAPED_FIELDS = ["position", "company", "location"]

RUN_STATUSES = ["success", "failed"]
REGIONS = [
    "North America", "Latin America", "Europe", "Middle East", "Africa",
    "Asia-Pacific", "Worldwide", "Unspecified",
]
UNSPECIFIED = "Unspecified"
CATEGORY_LABELS = {"bi": "BI", "ml": "ML", "devops": "DevOps"}

ACTIVE_WINDOW_DAYS = 14
FRESHNESS_WARN_HOURS = 30
FRESHNESS_ERROR_HOURS = 72
TOP_SKILLS = 15
TREND_SKILLS = 8
MIN_TREND_DAYS = 2
ALL_CATEGORIES = "All categories"

# --- fixed values: lookup tables ---------------------------------------------

# (skill_name, category, match_keyword)
SKILL_KEYWORDS = [
    ("Python", "language", "python"),
    ("SQL", "language", "sql"),
    ("Java", "language", "java"),
    ("Scala", "language", "scala"),
    ("Apache Airflow", "orchestration", "airflow"),
    ("Dagster", "orchestration", "dagster"),
    ("Prefect", "orchestration", "prefect"),
    ("dbt", "transformation", "dbt"),
    ("Apache Spark", "processing", "spark"),
    ("Apache Kafka", "streaming", "kafka"),
    ("Snowflake", "warehouse", "snowflake"),
    ("BigQuery", "warehouse", "bigquery"),
    ("Redshift", "warehouse", "redshift"),
    ("Databricks", "warehouse", "databricks"),
    ("AWS", "cloud", "aws"),
    ("GCP", "cloud", "gcp"),
    ("Azure", "cloud", "azure"),
    ("Docker", "devops", "docker"),
    ("Kubernetes", "devops", "kubernetes"),
    ("Terraform", "devops", "terraform"),
    ("PostgreSQL", "database", "postgres"),
    ("MySQL", "database", "mysql"),
    ("MongoDB", "database", "mongodb"),
    ("ETL", "concept", "etl"),
    ("ELT", "concept", "elt"),
    ("Data Warehouse", "concept", "data warehouse"),
    ("Data Lake", "concept", "data lake"),
    ("Machine Learning", "ml", "machine learning"),
    ("Power BI", "bi", "power bi"),
    ("Tableau", "bi", "tableau"),
    ("Looker", "bi", "looker"),
    ("Git", "devops", "git"),
    ("CI/CD", "devops", "ci/cd"),
    ("REST API", "concept", "api"),
    ("NoSQL", "database", "nosql"),
]

# (match_keyword, region); a keyword may name several regions
REGION_KEYWORDS = [
    ("usa", "North America"),
    ("us", "North America"),
    ("united states", "North America"),
    ("canada", "North America"),
    ("northern america", "North America"),
    ("north america", "North America"),
    ("california", "North America"),
    ("new york", "North America"),
    ("los angeles", "North America"),
    ("redwood city", "North America"),
    ("cincinnati", "North America"),
    ("americas", "North America"),
    ("americas", "Latin America"),
    ("latam", "Latin America"),
    ("latin america", "Latin America"),
    ("south america", "Latin America"),
    ("brazil", "Latin America"),
    ("mexico", "Latin America"),
    ("argentina", "Latin America"),
    ("colombia", "Latin America"),
    ("chile", "Latin America"),
    ("europe", "Europe"),
    ("emea", "Europe"),
    ("emea", "Middle East"),
    ("emea", "Africa"),
    ("uk", "Europe"),
    ("united kingdom", "Europe"),
    ("germany", "Europe"),
    ("france", "Europe"),
    ("spain", "Europe"),
    ("netherlands", "Europe"),
    ("ireland", "Europe"),
    ("poland", "Europe"),
    ("portugal", "Europe"),
    ("israel", "Middle East"),
    ("saudi arabia", "Middle East"),
    ("united arab emirates", "Middle East"),
    ("uae", "Middle East"),
    ("qatar", "Middle East"),
    ("oman", "Middle East"),
    ("africa", "Africa"),
    ("nigeria", "Africa"),
    ("kenya", "Africa"),
    ("egypt", "Africa"),
    ("apac", "Asia-Pacific"),
    ("asia", "Asia-Pacific"),
    ("australia", "Asia-Pacific"),
    ("new zealand", "Asia-Pacific"),
    ("singapore", "Asia-Pacific"),
    ("malaysia", "Asia-Pacific"),
    ("japan", "Asia-Pacific"),
    ("south korea", "Asia-Pacific"),
    ("india", "Asia-Pacific"),
    ("telangana", "Asia-Pacific"),
    ("hong kong", "Asia-Pacific"),
    ("philippines", "Asia-Pacific"),
    ("indonesia", "Asia-Pacific"),
    ("vietnam", "Asia-Pacific"),
    ("worldwide", "Worldwide"),
    ("anywhere", "Worldwide"),
    ("global", "Worldwide"),
]

# (source_location, location_en)
LOCATION_TRANSLATIONS = [
    ("أبو ظبي, أبو ظبي أبو ظبي الإمارات العربية المتحدة", "Abu Dhabi, United Arab Emirates"),
    ("عسير, عسير السعودية", "Asir, Saudi Arabia"),
    ("دبي, دبي دبي الإمارات العربية المتحدة", "Dubai, United Arab Emirates"),
    ("مسقط", "Muscat, Oman"),
    ("مسقط, مسقط مسقط عمان", "Muscat, Oman"),
    ("那覇都市部", "Naha metropolitan area, Japan"),
    ("رأس الخيمة", "Ras Al Khaimah, United Arab Emirates"),
    ("الرياض, الرياض الرياض السعودية", "Riyadh, Saudi Arabia"),
    ("서울 인천 지역", "Seoul / Incheon area, South Korea"),
]
