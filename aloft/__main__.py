"""Run or inspect a registered query from the command line.

    python -m aloft list
    python -m aloft run route_counts /root/testdata/sf0.01 [--rows 20]
    python -m aloft explain pagerank_top /root/testdata/sf0.01
"""

from __future__ import annotations

import argparse

from aloft.plans.tables import ORACLE_SQL, QUERIES
from aloft.session import build_session, ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m aloft")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered queries (and whether an SQL oracle exists)")
    for cmd in ("run", "explain"):
        p = sub.add_parser(cmd)
        p.add_argument("query", choices=sorted(QUERIES))
        p.add_argument("sf_dir")
        p.add_argument("--master", default="local[*]")
        p.add_argument("--rows", type=int, default=20)
    args = ap.parse_args(argv)
    if args.cmd == "list":
        for name in QUERIES:
            print(f"{name:28s} {'sql oracle' if name in ORACLE_SQL else 'rows only'}")
        return
    spark = build_session(args.master)
    ensure_checkpoint_dir(spark)
    df = QUERIES[args.query](spark, args.sf_dir)
    if args.cmd == "run":
        df.show(args.rows, truncate=False)
    else:
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
