"""The daily job: land every source, then build.

    spark-submit --py-files postlode.zip postlode/plans/daily.py \\
        --warehouse /data/postings --dump remoteok=/dumps/a/2026-08-20 \\
        --dump remotive=/dumps/b/2026-08-20
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Mapping
from datetime import datetime, timezone

from postlode.params import Params
from postlode.plans.build import build_models
from postlode.plans.ingest import SOURCES, run_source
from postlode.session import build_session
from postlode.sources.tables import Warehouse

logger = logging.getLogger(__name__)


def run_daily(
    warehouse: Warehouse, dumps: Mapping[str, str], params: Params, *, keep_going: bool = False
) -> list:
    """Land each source's dump and build the models; returns the check results.

    With ``keep_going`` a source that fails does not stop the other sources or
    the build, and its error is raised at the end.
    """
    failure: Exception | None = None
    for spec in SOURCES:
        if spec.name not in dumps:
            continue
        try:
            run_source(warehouse, spec, dumps[spec.name])
        except Exception as error:
            if not keep_going:
                raise
            failure = failure or error
    results = build_models(warehouse, params)
    if failure is not None:
        raise failure
    return results


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--warehouse", required=True, help="shared folder of all tables")
    parser.add_argument("--dump", action="append", default=[], metavar="SOURCE=PATH")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="default: now")
    parser.add_argument("--active-window-days", type=int)
    parser.add_argument("--keep-going", action="store_true")
    args = parser.parse_args(argv)

    as_of = args.as_of or datetime.now(timezone.utc)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    window = {} if args.active_window_days is None else {
        "active_window_days": args.active_window_days
    }
    spark = build_session("postlode-daily")
    results = run_daily(
        Warehouse(spark, args.warehouse),
        dict(d.split("=", 1) for d in args.dump),
        Params(as_of, **window),
        keep_going=args.keep_going,
    )
    for row in results:
        print(f"{row['status']:5} {row['check']}: {row['failures']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
