"""Jobs to submit: ``spark-submit -m forumlens <job> ...`` or ``python -m forumlens <job> ...``."""

from __future__ import annotations

import argparse
import importlib
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from forumlens.functions.lexicon import read_lexicon
from forumlens.plans import extraction, jobs
from forumlens.plans.batch import Folders, Settings, run_batch
from forumlens.runtime import drop_materialized, ship_package


def _named(name: str):
    """An object given as ``module:attribute``, such as the factory of a scorer."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="forumlens", description=__doc__)
    chosen = parser.add_subparsers(dest="job", required=True)

    batch = chosen.add_parser("batch", help="one batch from raw posts to alerts")
    for name in ("raw", "work", "warehouse", "ledger", "batches", "lexicon", "alerts"):
        batch.add_argument(f"--{name}", required=True)
    batch.add_argument("--time", required=True, type=datetime.fromisoformat, help="run time in UTC")
    batch.add_argument("--scorer", required=True, help="module:attribute of a scorer factory")
    batch.add_argument("--footer")

    transform = chosen.add_parser("transform", help="statics to sentences and keyword tags")
    transform.add_argument("--posts", nargs="*", default=[])
    transform.add_argument("--comments", nargs="*", default=[])
    for name in ("out", "lexicon"):
        transform.add_argument(f"--{name}", required=True)
    for job in (batch, transform):
        job.add_argument("--balance-chars", type=int)
        job.add_argument("--splitter", help="module:attribute of a sentence model factory")
        job.add_argument("--strict", action="store_true", help="mask addresses broken by no-break spaces")
        job.add_argument("--distinct", action="store_true", help="a keyword listed twice tags once")

    delta = chosen.add_parser("delta", help="change between two snapshots")
    delta.add_argument("--before")
    for name in ("after", "out"):
        delta.add_argument(f"--{name}", required=True)
    delta.add_argument("--keys", nargs="+", default=["id"])

    trend = chosen.add_parser("trend", help="newest trend and its alerts")
    for name in ("warehouse", "alerts"):
        trend.add_argument(f"--{name}", required=True)
    trend.add_argument("--time", required=True, type=datetime.fromisoformat, help="local time shown in alerts")
    trend.add_argument("--threshold", type=float, default=2.0)
    trend.add_argument("--footer")

    combine = chosen.add_parser("combine", help="raw posts to flat tables, and the ledger of ids")
    for name in ("raw", "ledger", "out", "batch"):
        combine.add_argument(f"--{name}", required=True)
    combine.add_argument("--base", help="folder whose partition folders count, above a globbed path")
    combine.add_argument("--time", required=True, type=datetime.fromisoformat, help="local time of the counters")
    combine.add_argument("--lines", action="store_true", help="a document is a line, not a file")
    combine.add_argument("--keep-repeats", action="store_true")

    sentiment = chosen.add_parser("sentiment", help="score every sentence file below a prefix")
    for name in ("source", "target", "scorer"):
        sentiment.add_argument(f"--{name}", required=True)

    extract = chosen.add_parser("extract", help="saved pages to raw posts and run results")
    for name in ("pages", "out", "results"):
        extract.add_argument(f"--{name}", required=True)
    extract.add_argument("--layout", required=True, action="append", metavar="COMMUNITY=KIND", help=f"one of {', '.join(extraction.KINDS)}")
    extract.add_argument("--time", required=True, type=datetime.fromisoformat, help="run time in UTC")

    report = chosen.add_parser("report", help="run results to the report message")
    for name in ("results", "out"):
        report.add_argument(f"--{name}", required=True)
    report.add_argument("--communities", nargs="+", required=True)
    for name in ("time", "started", "ended"):
        report.add_argument(f"--{name}", required=True, type=datetime.fromisoformat, help="in UTC")
    return parser


def _options(args: argparse.Namespace) -> dict:
    from forumlens.functions.text import split_sentences
    from forumlens.operators.sentences import plugin_splitter

    splitter = plugin_splitter(_named(args.splitter)) if args.splitter else split_sentences
    return {"balance_chars": args.balance_chars, "splitter": splitter, "strict": args.strict, "distinct": args.distinct}


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"forumlens-{args.job}").getOrCreate()
    ship_package(spark)
    try:
        if args.job == "batch":
            folders = Folders(args.raw, args.work, args.warehouse, args.ledger, args.batches)
            settings = Settings(read_lexicon(spark, args.lexicon), _named(args.scorer), footer=args.footer, **_options(args))
            run_batch(spark, folders, args.time, settings).write.mode("overwrite").json(args.alerts)
        elif args.job == "transform":
            jobs.run_transform_static(spark, args.posts, args.comments, args.out, read_lexicon(spark, args.lexicon), **_options(args))
        elif args.job == "delta":
            jobs.run_delta(spark, args.before, args.after, args.out, args.keys)
        elif args.job == "combine":
            now = F.lit(args.time.isoformat(sep=" ")).cast("timestamp_ntz")
            jobs.run_combine(
                spark, args.raw, args.ledger, args.out, args.batch, now, not args.lines, args.base, keep_repeats=args.keep_repeats)
        elif args.job == "sentiment":
            jobs.run_sentiment(spark, args.source, args.target, _named(args.scorer))
        elif args.job == "extract":
            layouts = {name: extraction.KINDS[kind] for name, kind in (pair.split("=", 1) for pair in args.layout)}
            extraction.run_extract(spark, spark.read.parquet(args.pages), args.out, args.results, layouts, args.time)
        elif args.job == "report":
            extraction.run_report(spark, args.results, args.out, args.communities, args.time, args.started, args.ended)
        else:
            now = F.lit(args.time.isoformat(sep=" ")).cast("timestamp_ntz")
            alerts = jobs.run_trend(spark, args.warehouse, now, k=args.threshold, footer=args.footer)
            alerts.write.mode("overwrite").json(args.alerts)
    finally:
        drop_materialized(spark)


if __name__ == "__main__":
    main()
