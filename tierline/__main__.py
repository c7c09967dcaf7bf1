"""Command line: run one stage of the medallion flow and print its counts.

    python -m tierline treks   <treks.csv> <out_root>
    python -m tierline ingest  <treks.csv> <out_root>          # reports + valid/skipped CSV
    python -m tierline weather <docs glob> <out_root> [--lines]
    python -m tierline weather-stream <landing dir> <hours path> --checkpoint C [--name N]
    python -m tierline ledger  <valid places parquet> <docs glob> <out_root>
    python -m tierline warehouse <treks gold> <weather gold> <weather summary>
                                 [--grain hour|entity|union] [--mart-path P]

Master and cluster settings come from ``spark-submit`` / the environment.
"""

from __future__ import annotations

import argparse
import json
import sys

from tierline.session import get_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(
        prog="tierline", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("treks", "ingest"):
        s = sub.add_parser(name)
        s.add_argument("csv")
        s.add_argument("out_root")
    s = sub.add_parser("weather")
    s.add_argument("docs")
    s.add_argument("out_root")
    s.add_argument("--lines", action="store_true", help="one document per line instead of per file")
    s = sub.add_parser("weather-stream")
    s.add_argument("landing")
    s.add_argument("silver")
    s.add_argument("--checkpoint", required=True, help="shared folder, the same for every run")
    s.add_argument("--name", default="weather_silver")
    s = sub.add_parser("ledger")
    s.add_argument("valid_places")
    s.add_argument("docs")
    s.add_argument("out_root")
    s = sub.add_parser("warehouse")
    s.add_argument("treks_gold")
    s.add_argument("weather_gold")
    s.add_argument("weather_summary")
    s.add_argument("--grain", default="hour", choices=["hour", "entity", "union"])
    s.add_argument("--mart-path", default=None)
    args = p.parse_args(argv)

    spark = get_session("tierline-" + args.cmd)
    out: dict
    if args.cmd == "treks":
        from tierline.plans.treks import run_treks

        out = run_treks(spark, args.csv, args.out_root)
    elif args.cmd == "ingest":
        from tierline.plans.treks import run_trek_ingest

        out = run_trek_ingest(spark, args.csv, args.out_root)
    elif args.cmd == "weather":
        from tierline.plans.weather import run_weather

        out = run_weather(spark, args.docs, args.out_root, multi_line=not args.lines)
    elif args.cmd == "weather-stream":
        from tierline.streaming import start_weather_ingest

        q = start_weather_ingest(spark, args.landing, args.silver, args.checkpoint, name=args.name)
        q.awaitTermination()
        out = {"silver": args.silver, "last_progress": q.lastProgress}
    elif args.cmd == "ledger":
        from tierline.plans.weather import run_ledger

        out = run_ledger(spark, spark.read.parquet(args.valid_places), args.docs, args.out_root)
    else:
        from tierline.plans.warehouse import run_warehouse

        res = run_warehouse(
            spark, args.treks_gold, args.weather_gold, args.weather_summary, args.grain, args.mart_path
        )
        out = {k: [r.asDict() for r in res[k].collect()] for k in ("profiles", "tests")}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
