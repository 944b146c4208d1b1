"""Run one registered query, or one read-only SQL statement, and show the result.

    python -m relq <query> [sf_dir] [--rows N]
    python -m relq --sql "SELECT ..." [sf_dir] [--rows N]
    python -m relq --list

Prints the row count and the first N rows, as the course's run button does.
The query runs once: its result is written to the shared folder, the count
observed on the way, and the preview is a ``LIMIT`` over what was written; the
full result never passes through the driver.
"""

from __future__ import annotations

import argparse
import sys
import tempfile
import uuid

from relq.plans.catalog import REGISTRY
from relq.session import ensure_checkpoint_dir, local_session
from relq.sources.adhoc import run_sql
from relq.sources.tables import preview, register_views, remove, write_result

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "labels"]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="relq")
    ap.add_argument("query", nargs="?")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--sql")
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--list", action="store_true")
    args = ap.parse_args(argv)
    if args.list:
        print("\n".join(sorted(REGISTRY)))
        return 0
    spark = local_session()
    if args.sql:
        if args.query:  # positional slot holds the folder when --sql is used
            args.sf_dir = args.query
        register_views(spark, args.sf_dir, TABLES)
        df, err = run_sql(spark, args.sql)
        if err:
            print(f"error: {err}", file=sys.stderr)
            return 1
    elif args.query in REGISTRY:
        df = REGISTRY[args.query](spark, args.sf_dir)
    else:
        print(f"unknown query {args.query!r}; --list shows the names", file=sys.stderr)
        return 2
    path = f"{ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix='relq-'))}/relq-result-{uuid.uuid4().hex}"
    try:
        print(f"{write_result(df, path)['rows']} rows")
        preview(spark.read.schema(df.schema).parquet(path), args.rows).show(args.rows, truncate=False)
    finally:
        remove(spark, path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
