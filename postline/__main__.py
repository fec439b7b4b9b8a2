"""Command line: spark-submit .. postline/__main__.py land|transform|load|daily .."""

import argparse
import datetime

from postline import fixed_values as fixed
from postline.plans import daily
from postline.session import build_session
from postline.sources.tables import create_tables


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="postline", description=__doc__)
    parser.add_argument("step", choices=["land", "transform", "load", "daily"])
    parser.add_argument("--root", required=True, help="folder of the zones and the tables")
    parser.add_argument("--payload", help="collected timelines (land, daily)")
    parser.add_argument("--db", default="timelines")
    parser.add_argument(
        "--as-of", type=datetime.date.fromisoformat, default=datetime.datetime.now(datetime.UTC).date()
    )
    parser.add_argument("--newest", type=int, default=fixed.TIMELINE_LENGTH, help="posts per account, 0 for all (land, daily)")
    parser.add_argument("--account", help="whose the landing files are, if they do not say so (transform, daily)")
    args = parser.parse_args(argv)
    if args.step == "land" and not args.payload or args.step == "daily" and not (args.payload or args.account):
        parser.error(f"{args.step} needs --payload")
    spark = build_session(f"postline {args.step}")
    create_tables(spark, args.db, f"{args.root.rstrip('/')}/warehouse")
    if args.step == "land":
        daily.land(spark, args.payload, args.root, args.newest or None)
    elif args.step == "transform":
        done = daily.transform(spark, args.root, args.db, args.as_of, args.account)
        print("processed" if done else "nothing new")
    elif args.step == "load":
        daily.load(spark, args.root, args.db, args.as_of)
    else:
        loaded = daily.run_day(
            spark, args.payload, args.root, args.db, args.as_of, args.newest or None, args.account
        )
        print("loaded" if loaded else "nothing new")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
