"""Command line: ``python -m varloom <command>``, or the start script under spark-submit."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from varloom.plans.convert import convert_release
from varloom.plans.pipeline import FeatureConfig, run_pipeline
from varloom.session import build_session
from varloom.sources.vcf import DEFAULT_VCF_NAME, list_fields


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="varloom", description="Variant-annotation tables on Spark")
    top.add_argument("--master", default=None, help="Spark master; leave out under spark-submit")
    commands = top.add_subparsers(dest="command", required=True)

    convert = commands.add_parser("convert", help="annotated VCF files to the long Parquet table")
    convert.add_argument("--annotation-root", required=True)
    convert.add_argument("--outdir", default="results")
    convert.add_argument("--shards", default="shard-*")
    convert.add_argument("--subshards", default="subshard-*")
    convert.add_argument("--vcf-name", default=DEFAULT_VCF_NAME)
    convert.add_argument("--annotation-field", default="CSQ")
    convert.add_argument("--region", action="append", help="chr:start-end; may be repeated")
    convert.add_argument("--max-af", type=float)
    convert.add_argument("--max-ac", type=int)
    convert.add_argument("--packed-ann", action="store_true", help="leave ANN as one text column")

    fields = commands.add_parser("list-fields", help="resolved columns of one file")
    fields.add_argument("path")
    fields.add_argument("--annotation-field", default="CSQ")

    features = commands.add_parser("features", help="feature table from a JSON file of FeatureConfig values")
    features.add_argument("config")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("varloom", args.master)
    if args.command == "convert":
        convert_release(
            spark, args.annotation_root, args.outdir, args.annotation_field, args.shards, args.subshards,
            args.vcf_name, args.max_af, args.max_ac, not args.packed_ann, args.region)
    elif args.command == "list-fields":
        for row in list_fields(spark, args.path, args.annotation_field).orderBy("position").collect():
            print(row.name)
    else:
        with open(args.config) as file:
            run_pipeline(spark, FeatureConfig(**json.load(file)))


if __name__ == "__main__":
    main()
