"""Command line: run the jobs the reference ran as notebooks.

  python -m podium run --sheets DIR --dictionary FILE --out DIR [--compat] [--splittable]
  python -m podium score --fact PATH --out DIR [--rounds PATH] [--compat]
  python -m podium query NAME [--sf DIR] [--rows N]

Under spark-submit the cluster's session is used as configured; run directly,
a local session is built.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    if os.environ.get("SPARK_SUBMIT_OPTS") or "spark.master" in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        return SparkSession.builder.getOrCreate()
    from podium.session import build_session
    return build_session(master=os.environ.get("PODIUM_MASTER", "local[*]"))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="podium")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("run", help="sheet text files -> CSV -> landing -> silver -> gold")
    p.add_argument("--sheets", required=True)
    p.add_argument("--dictionary", required=True, help="text file, one code per line")
    p.add_argument("--out", required=True)
    p.add_argument("--load-time")
    p.add_argument("--compat", action="store_true")
    p.add_argument("--splittable", action="store_true")
    s = sub.add_parser("score", help="finalist scoring of a gold fact table")
    s.add_argument("--fact", required=True)
    s.add_argument("--rounds", help="gold round dimension (default: gold_dim_round beside the fact)")
    s.add_argument("--out", required=True)
    s.add_argument("--compat", action="store_true")
    q = sub.add_parser("query", help="run one registered verification query")
    q.add_argument("name")
    q.add_argument("--sf", default="/root/testdata/sf0.01")
    q.add_argument("--rows", type=int, default=20)
    a = ap.parse_args(argv)

    spark = _session()
    from podium.plans import jobs
    if a.cmd == "run":
        words = spark.read.text(a.dictionary).selectExpr("trim(value) AS w").filter("w <> ''").distinct()
        paths = jobs.sheets_to_gold(spark, a.sheets, words, a.out, a.load_time, a.compat, splittable=a.splittable)
        print(json.dumps(paths, indent=2))
    elif a.cmd == "score":
        rounds = a.rounds or os.path.join(os.path.dirname(a.fact.rstrip("/")), "gold_dim_round")
        print(json.dumps(jobs.finalist_job(spark, a.fact, a.out, a.compat, rounds_path=rounds), indent=2))
    else:
        from podium.plans.queries import QUERIES
        QUERIES[a.name](spark, a.sf).show(a.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
