"""Command line: ``python -m tidemark preprocess|model --config FILE`` or ``synthesize --customers N --out PATH``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("preprocess", "model"):
        one = commands.add_parser(name)
        one.add_argument("--config", required=True)
        one.add_argument("--format", default="parquet", choices=("parquet", "csv", "orc"))
    make = commands.add_parser("synthesize")
    make.add_argument("--customers", type=int, default=25_000)
    make.add_argument("--out", required=True)
    make.add_argument("--seed", type=int, default=7)
    make.add_argument("--base-rate", type=float, default=0.02)
    make.add_argument("--format", default="parquet", choices=("parquet", "csv", "orc"))
    more = commands.add_parser("extend-grids")
    more.add_argument("--config", required=True)
    more.add_argument("--artifact", required=True)
    more.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"tidemark {args.command}").getOrCreate()
    if args.command == "synthesize":
        from .sources.synthetic import acquisitions, ordered

        rows = acquisitions(spark, args.customers, args.seed, args.base_rate)
        ordered(rows).write.mode("overwrite").option("header", True).format(args.format).save(args.out)
    elif args.command == "extend-grids":
        from .plans.preprocess import run_extension

        run_extension(spark, args.config, args.artifact, args.out)
    elif args.command == "preprocess":
        from .plans.preprocess import run

        for name, size in run(spark, args.config, args.format).items():
            print(name, size)
    else:
        from .plans.modelling import run as model

        for name, size in model(spark, args.config, args.format).items():
            print(name, size)


if __name__ == "__main__":
    main()
