"""Command line: translate, qe, to-sample, lowercase, sample."""

from __future__ import annotations

import argparse
import dataclasses
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from textloom.config import Config
from textloom.operators.qe import score_combined, score_paired
from textloom.operators.rows import head, require
from textloom.plans import run as plans
from textloom.plans import tools
from textloom.sources.csv import default_path, read_csv, read_records, write_csv, write_records


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="textloom")
    kinds = top.add_subparsers(dest="command", required=True)
    run = kinds.add_parser("translate")
    named = {"input_path": "--input", "output_path": "--output", "model_name": "--model", "report_path": "--report", "progress_path": "--progress-file"}
    for f in dataclasses.fields(Config):
        flag = named.get(f.name, "--" + f.name.replace("_", "-"))
        if "bool" in f.type:
            run.add_argument(flag, dest=f.name, action=argparse.BooleanOptionalAction, default=None)
        else:
            run.add_argument(flag, dest=f.name, default=None)
    run.add_argument("--disable-qe", dest="enable_qe", action="store_false", default=None)
    qe = kinds.add_parser("qe")
    for flag in ("--input", "--source-input", "--translated-input", "--model"):
        qe.add_argument(flag)
    qe.add_argument("--output", required=True)
    qe.add_argument("--source-column", default="message")
    qe.add_argument("--translated-column", default="message")
    qe.add_argument("--backend", default="comet")
    qe.add_argument("--high", type=float, default=0.7)
    qe.add_argument("--medium", type=float, default=0.4)
    qe.add_argument("--limit", type=int)
    export = kinds.add_parser("to-sample")
    for flag in ("autopopulate-url-like", "drop-skipped-max-translate-tokens", "remove-emoji-placeholders", "lowercase-messages", "remove-punctuation"):
        export.add_argument(f"--{flag}", action="store_true")
    lower, sample = kinds.add_parser("lowercase"), kinds.add_parser("sample")
    sample.add_argument("--rows", type=int, required=True)
    for p in (export, lower, sample):
        p.add_argument("--input", required=True)
        p.add_argument("--output")
    return top


def _qe(spark: SparkSession, args: argparse.Namespace) -> str:
    if bool(args.input) == bool(args.source_input or args.translated_input) or bool(args.source_input) != bool(args.translated_input):
        raise ValueError("give either --input, or both --source-input and --translated-input")
    if args.input and args.source_column == args.translated_column:
        raise ValueError("one table needs two columns")

    def rows(path: str):
        whole = read_csv(spark, path, na_values=True)
        return head(whole, args.limit) if args.limit else whole

    options = {"backend": args.backend, "model_name": args.model, "high": args.high, "medium": args.medium}
    if args.input:
        scored = score_combined(require(rows(args.input), [args.source_column, args.translated_column]), args.source_column, args.translated_column, **options)
    else:
        left, right = require(rows(args.source_input), [args.source_column]), require(rows(args.translated_input), [args.translated_column])
        scored = score_paired(left, right, args.source_column, args.translated_column, **options)
    n, mean = plans.qe_run(scored.orderBy("input_row_number").drop("input_row_number"), args.output)
    return f"rows: {n}, mean score: {'n/a' if mean is None else f'{mean:.6f}'}"


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> str:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("textloom").getOrCreate()
    if args.command == "translate":
        given = {k: v for k, v in vars(args).items() if k != "command"}
        config = Config.load(given | {"progress_path": given["progress_path"] or default_path(Config.load(given).output_path, "progress")})
        logging.basicConfig(level=config.log_level.upper(), filename=config.log_file)
        report = plans.run(spark, config)
        return f"rows: {report['rows_processed']}"
    if args.command == "qe":
        return _qe(spark, args)
    kind = {"to-sample": "sample", "lowercase": "lowercase", "sample": "first"}[args.command]
    output = args.output or default_path(args.input, kind, getattr(args, "rows", None))
    if args.command == "sample":  # records as they stand, whatever fields each has
        header, records = read_records(spark, args.input)
        return f"rows: {write_records(header, head(records, args.rows), output)}"
    own = read_csv(spark, args.input).orderBy("input_row_number").drop("input_row_number")
    switches = {k: v for k, v in vars(args).items() if isinstance(v, bool)}
    done = tools.sample_export(own, **switches) if args.command == "to-sample" else tools.lowercase_messages(own)
    return f"rows: {write_csv(done, output)}"


if __name__ == "__main__":
    print(main())
