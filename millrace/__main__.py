"""Command line: ``python -m millrace wiki|tsv|train-quality``; results go to stdout as JSON."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.operators.staging import exists, staged, write_text
from millrace.plans import pipeline
from millrace.plans.config import TSV, WIKI, QualityConfig, RunConfig, from_json, merged
from millrace.runtime import configure_environment
from millrace.session import build_session, ship_code
from millrace.sources import download, readers, sinks


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millrace", description="Prepare text corpora with Spark.")
    parser.add_argument("--master", default=None, help="Spark master; unset under spark-submit")
    parser.add_argument("--seed", type=int, default=42)
    kinds = parser.add_subparsers(dest="kind", required=True)
    for kind, what in (("wiki", "a wiki dump in XML, plain or compressed"), ("tsv", "tab-separated documents: id, url, title, body")):
        p = kinds.add_parser(kind, help=what)
        p.add_argument("--input", required=True, help=what)
        p.add_argument("--output", required=True, help="output folder on any file system that Spark knows")
        p.add_argument("--url", default=None, help="fetch the input from here first, where it isn't there already")
        p.add_argument("--sha256", default=None)
        p.add_argument("--size", type=int, default=None)
        p.add_argument("--config", default=None, help="JSON file of changes to the preset")
        p.add_argument("--set", action="append", default=[], metavar="NAME=JSON", help="one setting, such as near.hamming_threshold=2")
        p.add_argument("--title", default=kind)
        p.add_argument("--push", default=None, metavar="REPOSITORY", help="upload the finished folder")
        p.add_argument("--dry-run", action="store_true", help="do all but the upload")
    kinds.choices["wiki"].add_argument("--namespace", type=int, default=0)
    kinds.choices["wiki"].add_argument("--redirects", action="store_true")
    kinds.choices["wiki"].add_argument("--parser", choices=("patterns", "library"), default="patterns")
    kinds.choices["wiki"].add_argument("--require-parser", action="store_true")
    t = kinds.add_parser("train-quality", help="train the quality model and calibrate its threshold")
    t.add_argument("--train-file", required=True, help="lines of a label, a space and a text")
    t.add_argument("--model-out", required=True)
    t.add_argument("--validation-file", default=None)
    t.add_argument("--calibration-out", default=None)
    t.add_argument("--positive-label", default=QualityConfig.positive_label)
    t.add_argument("--epochs", type=int, default=10)
    t.add_argument("--features", type=int, default=1 << 16)
    t.add_argument("--regularisation", type=float, default=1e-4)
    return parser


def settings(preset: RunConfig, path: str | None, changes: Sequence[str]) -> RunConfig:
    """The preset with a file's changes and then single ones; values are JSON, or text where they aren't."""
    config = from_json(path, preset) if path else preset
    for change in changes:
        name, found, value = change.partition("=")
        if not found:
            raise ValueError(f"not NAME=JSON: {change!r}")
        try:
            value = json.loads(value)
        except json.JSONDecodeError:
            pass
        for part in reversed(name.split(".")):
            value = {part: value}
        config = merged(config, value)
    return config


def _rows(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Clean rows with a dense _ord; lines of a TSV count as they stand in the file, malformed ones too, and a dump's accepted pages."""
    if args.kind == "wiki":
        pages = staged(readers.read_pages(spark, args.input, args.namespace, args.redirects), "pages")
        return readers.clean_wiki(readers.dense_order(pages), parser=args.parser, required=args.require_parser)
    lines = staged(readers.read_tsv(spark, args.input), "lines")
    return readers.clean_tsv(readers.dealt(readers.dense_order(lines), lines.count()))


def prepare(spark: SparkSession, args: argparse.Namespace) -> dict[str, Any]:
    config = settings(WIKI if args.kind == "wiki" else TSV, args.config, args.set)
    if args.url:
        download.download(args.url, args.input, sha256=args.sha256, size=args.size)
    elif args.sha256 or args.size is not None:
        download.verify(args.input, args.sha256, args.size)
    summary = pipeline.run(_rows(spark, args), args.output, config, title=args.title, source=args.url or args.input)
    if args.push:
        sinks.publish(args.output, args.push, dry_run=args.dry_run)
    return summary


def train_quality(spark: SparkSession, args: argparse.Namespace) -> dict[str, Any]:
    for path in (args.train_file, args.validation_file):
        if path and not exists(spark, path):
            raise ValueError(f"there is no file {path}")
    labelled = lambda path: readers.read_labelled(spark, path).withColumn("y", (F.col("label") == args.positive_label).cast("double"))
    samples = staged(labelled(args.train_file), "samples")
    model = quality.LinearModel.train(samples.select("text", F.col("y").alias("label")), args.epochs, args.features, args.regularisation, args.positive_label)
    model.save(args.model_out, overwrite=True)
    out: dict[str, Any] = {"model_out": args.model_out, "positive_label": args.positive_label}
    if args.validation_file:
        scores = model.score(labelled(args.validation_file), "text", "score").select("score", F.col("y").alias("label"))
        out |= {"validation_file": args.validation_file, "calibration": quality.calibrate(scores).first().asDict()}
        if args.calibration_out:
            write_text(spark, args.calibration_out, json.dumps(out, indent=2))
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    log = configure_environment(seed=args.seed)
    spark = spark or build_session("millrace", args.master)
    ship_code(spark)
    result = (train_quality if args.kind == "train-quality" else prepare)(spark, args)
    log.info("%s done", args.kind)
    json.dump(result, sys.stdout, indent=2, ensure_ascii=False)
    print()
    return 0


if __name__ == "__main__":
    sys.exit(main())
