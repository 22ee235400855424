"""Load a folder of payments: ``spark-submit -m riskflow`` or ``python -m riskflow``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.functions.rules import DEFAULT_RULES, load_rules
from riskflow.plans.loads import LoadSettings, load_folder
from riskflow.session import tuned
from riskflow.sources.registry import from_snapshot, read_registry, refresh_cache
from riskflow.streaming import ingest


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="riskflow", description=__doc__)
    parser.add_argument("input", help="folder of payment files")
    parser.add_argument("fact", help="fact table folder")
    parser.add_argument("audit", help="audit event folder")
    parser.add_argument("--registry", required=True, help="company registry table")
    parser.add_argument("--cache", help="registry cache table, looked at before the registry")
    parser.add_argument("--rules", default=str(DEFAULT_RULES), help="rule file")
    parser.add_argument("--batch-size", type=int, help="rows per batch of a sorted file")
    parser.add_argument("--rejects", help="folder for rows that cannot land")
    parser.add_argument("--unit", choices=("file", "folder"), default="file")
    parser.add_argument("--one-job", action="store_true", help="all files in a single job")
    parser.add_argument("--stream", metavar="CHECKPOINT", help="keep loading what arrives")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = tuned(SparkSession.builder.appName("riskflow")).getOrCreate()
    now = datetime.now(timezone.utc)
    settings = LoadSettings(
        as_of=ingest.business_date(now),
        run_time=now,
        rules=load_rules(args.rules),
        batch_size=args.batch_size,
        reject_path=args.rejects,
    )
    snapshot = read_registry(spark, args.registry)

    def through_cache(companies: DataFrame) -> DataFrame:
        moment = F.lit(datetime.now(timezone.utc))
        return refresh_cache(companies, args.cache, from_snapshot(snapshot), moment)

    registry = through_cache if args.cache else snapshot
    if args.stream:
        ingest.start(
            spark, args.input, registry, args.fact, args.audit, args.stream,
            ingest.running_now(settings), args.unit,
            max_files=1 if args.unit == "file" else None,
        ).awaitTermination()
    else:
        load_folder(
            spark, args.input, registry, args.fact, args.audit, settings,
            unit=args.unit, one_job=args.one_job,
        )


if __name__ == "__main__":
    main()
