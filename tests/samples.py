"""Dumps of both sources, made up for these tests."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta, timezone

from postlode.plans.ingest import SOURCE_A, SOURCE_B, run_source
from postlode.sources.tables import Warehouse
from test_text import damage

T0 = datetime(2026, 8, 20, 6, tzinfo=timezone.utc)
DAY = timedelta(days=1)

NOTICE = {"terms": "This feed may be quoted with its name.", "generated_at": 20260820}
A1 = {
    "id": "tern-1", "slug": "spark-lead", "epoch": 1787000000, "company": "Ochre Works",
    "position": "Spark Platform Lead", "tags": ["spark ", "Kafka"],
    "description": "<p>Kafka on GCP; Scala &amp; Terraform.</p>",
    "location": "Porto, Portugal", "url": "https://a.example/t1", "salary_min": 0, "salary_max": 61000.25,
}
A2 = {
    "id": "tern-2", "slug": "cellist", "epoch": 1786950123, "company": "Quartet", "position": "Cellist",
    "tags": ["strings"], "description": "Chamber music, two concerts weekly.", "location": "Graz, ",
    "url": "https://a.example/t2", "salary_min": 0, "salary_max": 0,
}
A3 = {
    "id": "tern-3", "slug": "tinkerer", "epoch": 1786950123, "company": "Tern &amp; Tide",
    "position": "Backend Tinkerer", "tags": ["mysql"], "description": "MySQL, Docker and a bit of Java.",
    "location": "Remote", "url": "https://a.example/t3", "salary_min": 52000, "salary_max": 0,
}
DUMP_A = [A2, A3, NOTICE, A1]


def posting_b(key, title, company, category, tags, location, description):
    return {
        "id": key, "url": f"https://b.example/{key}", "title": title, "company_name": company,
        "category": category, "tags": tags, "job_type": "contract",
        "publication_date": "2026-08-18T03:04:05", "candidate_required_location": location,
        "salary": "", "description": description,
    }


B1 = posting_b(
    8101, "Data Steward", "Tern & Tide", "Data and Analytics", ["bigquery", "looker"], "Brazil, Canada", "<p>dbt</p>"
)
B2 = posting_b(
    8102, "Reliability Hand", "Umber", "DevOps / Sysadmin", ["terraform", "git"], "Worldwide", "CI/CD."
)
B3 = posting_b(8103, "Notary", "Seal", "Legal", ["law"], "Worldwide", "Python is a snake.")
B4 = posting_b(8104, "Rust Smith", "Tern & Tide", "Software Development", [], "Germany, Qatar", "Quiet work.")
DUMP_B = {"count": 4, "jobs": [B1, B2, B3, B4]}


def dump(folder, name, content) -> str:
    path = f"{folder}/{name}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/dump.json", "w", encoding="utf-8") as f:
        json.dump(content, f, ensure_ascii=False)
    return path


def at(*times):
    """A clock that gives these times in turn and then stays at the last."""
    left = list(times)
    return lambda: left.pop(0) if len(left) > 1 else left[0]


def land(spark, folder, a=DUMP_A, b=DUMP_B, now=T0, tag="0") -> Warehouse:
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    run_source(warehouse, SOURCE_A, dump(folder, f"a{tag}", a), clock=at(now))
    run_source(warehouse, SOURCE_B, dump(folder, f"b{tag}", b), clock=at(now))
    return warehouse
