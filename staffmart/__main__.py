"""Command line, also for ``spark-submit``: the session's master and resources are the platform's.

``python -m staffmart run DATA_DIR [--out DIR] [--query NAME ...] [--current-year-only]``,
``python -m staffmart run --sources MAP.json [...]`` over real personnel tables,
``python -m staffmart show DATA_DIR NAME [--explain]`` or
``python -m staffmart plans DATA_DIR OUT_DIR [NAME ...]``.

``MAP.json`` maps each personnel table to ``{"kind": "parquet" | "orc" | "table" | "jdbc",
"path": ..., "options": {...}}``.
"""

from __future__ import annotations

import argparse
import json

from staffmart.session import session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="staffmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="publish the mart and write every report")
    r.add_argument("data", nargs="?")
    r.add_argument("--sources", help="JSON file that maps personnel tables to locations")
    r.add_argument("--current-year-only", action="store_true", help="refresh the current year's partition only")
    r.add_argument("--out")
    r.add_argument("--query", action="append")
    s = sub.add_parser("show", help="print one query")
    s.add_argument("data")
    s.add_argument("name")
    s.add_argument("--explain", action="store_true")
    e = sub.add_parser("plans", help="write the formatted physical plan of queries to a folder")
    e.add_argument("data")
    e.add_argument("out")
    e.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    if args.cmd == "run" and bool(args.data) == bool(args.sources):
        ap.error("give either DATA_DIR or --sources")
    spark = session()
    if args.cmd == "run":
        from staffmart.plans.batch import run

        ctx = None
        if args.sources:
            from staffmart.plans.registry import context_for
            from staffmart.sources.loaders import Location, SourceMap

            with open(args.sources) as fh:
                places = {name: Location(**x) for name, x in json.load(fh).items()}
            ctx = context_for(SourceMap(places).tables(spark))
        print(json.dumps(run(spark, args.data, args.out, args.query, args.current_year_only, ctx), indent=1))
    elif args.cmd == "plans":
        import contextlib
        import io
        import os

        from staffmart.plans.registry import queries

        qs = queries()
        os.makedirs(args.out, exist_ok=True)
        for name in args.names or sorted(qs):
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                qs[name](spark, args.data).explain("formatted")
            with open(os.path.join(args.out, f"{name}.txt"), "w") as fh:
                fh.write(buf.getvalue())
            print(name)
    else:
        from staffmart.plans.registry import queries

        df = queries()[args.name](spark, args.data)
        if args.explain:
            df.explain("formatted")
        df.show(50, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
