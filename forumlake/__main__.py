"""The batch runs for spark-submit: python -m forumlake {land,parse,build,dashboard} ..."""

import argparse
import datetime as dt
import importlib

from pyspark.sql import SparkSession

from forumlake.plans import pipeline
from forumlake.session import configure
from forumlake.sources import releases, silver


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="forumlake")
    runs = parser.add_subparsers(dest="run", required=True)
    land = runs.add_parser("land", help="look up new ids and land them")
    land.add_argument("--bronze", required=True)
    land.add_argument("--mark", required=True, help="folder of the high-water mark")
    land.add_argument("--newest-id", type=int, required=True)
    land.add_argument("--items-per-run", type=int, help="take at most so many ids, oldest first; all by default")
    land.add_argument("--manifest", help="folder of the manifest of landed files")
    land.add_argument("--lookup", required=True, help="module:function from an id to an item")
    parse = runs.add_parser("parse", help="parse new and changed days")
    parse.add_argument("--bronze", required=True)
    parse.add_argument("--silver", required=True)
    parse.add_argument("--state", required=True, help="folder of the day state")
    parse.add_argument("--reload-shrunk", action="store_true")
    build = runs.add_parser("build", help="rebuild and check all models")
    build.add_argument("--silver", required=True)
    build.add_argument("--buckets", type=int)
    build.add_argument("--releases", help="folder of releases: publish all models at once; catalogue tables by default")
    back = runs.add_parser("rollback", help="have readers get an earlier release")
    back.add_argument("--releases", required=True)
    back.add_argument("--release", type=int, required=True)
    shown = runs.add_parser("dashboard", help="print the dashboard queries")
    shown.add_argument("--view", default="gold.story_analytics")
    shown.add_argument("--first", type=dt.date.fromisoformat)
    shown.add_argument("--last", type=dt.date.fromisoformat)
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = configure(SparkSession.builder.appName(f"forumlake {args.run}").getOrCreate())
    now = dt.datetime.now(dt.timezone.utc)
    if args.run == "land":
        module, function = args.lookup.split(":")
        lookup = getattr(importlib.import_module(module), function)
        landed, failed = pipeline.land_new_items(
            spark,
            args.bronze,
            args.mark,
            args.newest_id,
            lookup,
            now.date(),
            items_per_run=args.items_per_run,
            manifest_path=args.manifest,
        )
        print(f"{landed} items landed, {failed.count()} look-ups failed and are kept for the next run")
    elif args.run == "parse":
        run_id = int(now.timestamp())
        run = pipeline.parse_changed_days(spark, args.bronze, args.silver, args.state, run_id, args.reload_shrunk)
        print(f"{len(run.parsed)} days parsed", *run.parsed)
        print(f"{len(run.shrunk)} days lost files and were left alone", *run.shrunk)
    elif args.run == "build":
        items = silver.read_items(spark, args.silver)
        if args.releases:
            models = pipeline.publish_models(items, args.releases, int(now.timestamp()))
        else:
            models = pipeline.build_models(items, buckets=args.buckets)
        pipeline.check_models(models).show(truncate=False)
    elif args.run == "rollback":
        releases.move_to(spark, args.releases, args.release)
    else:
        for name, df in pipeline.dashboard_queries(spark.table(args.view), args.first, args.last).items():
            print(name)
            df.show(truncate=False)


if __name__ == "__main__":
    main()
