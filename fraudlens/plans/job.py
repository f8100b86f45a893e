"""Command line of the preprocessing job.

    python -m fraudlens.plans.job --transactions T --output O [--identities I] [--sample-size N]

Inputs are CSV or Parquet. Outputs are skipped when they are complete and were made from the same inputs.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from fraudlens.operators.ordering import head_sample
from fraudlens.plans.preprocess import preprocess, write_outputs
from fraudlens.schema import KEY, identity_schema, transaction_schema
from fraudlens.session import build_session, settle
from fraudlens.sources.manifest import REQUIRED_OUTPUTS, RunLog, catalog, existing_outputs, fingerprint, missing_outputs
from fraudlens.sources.sinks import write_manifest
from fraudlens.sources.tables import read_optional, read_table


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Prepare graph and tabular training data from raw transactions.")
    parser.add_argument("--transactions", required=True)
    parser.add_argument("--identities", help="optional; without it the job goes on with transactions alone")
    parser.add_argument("--output", required=True)
    parser.add_argument("--sample-size", type=int, help="first N transactions only, for debugging")
    parser.add_argument("--fit-on", choices=("train", "all"), default="train")
    parser.add_argument("--declared-schema", action="store_true", help="use the declared column types instead of finding them")
    return parser.parse_args(argv)


def _format(path: str) -> str:
    return "csv" if ".csv" in path.rsplit("/", 1)[-1] else "parquet"


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    """``skipped`` or ``written``; raises when an expected output is missing afterwards."""
    declared = (transaction_schema(), identity_schema()) if args.declared_schema else (None, None)
    tx = read_table(spark, args.transactions, _format(args.transactions), declared[0])
    idn = None
    if args.identities:
        idn = read_optional(spark, args.identities, _format(args.identities), schema=declared[1])
    tx, idn = head_sample(tx, idn, args.sample_size, KEY, [KEY])
    # text is parsed once; fingerprint, merge and counts read the written columns
    tx, idn = (settle(t, "input") if t is not None and fmt == "csv" else t for t, fmt in ((tx, _format(args.transactions)), (idn, _format(args.identities or ""))))
    mark = "/".join([fingerprint(tx), fingerprint(idn) if idn is not None else "none", args.fit_on])
    required = spark.createDataFrame([(p,) for p in REQUIRED_OUTPUTS], "path string")
    known = read_optional(spark, f"{args.output}/inputs", "text")
    if known is not None and mark in known.first()["value"]:
        if missing_outputs(required, existing_outputs(catalog(spark, args.output), args.output)).isEmpty():
            return "skipped"
    with RunLog(spark, f"{args.output}/runs", "preprocess") as record:
        write_outputs(preprocess(tx, idn, fit_on=args.fit_on), args.output)
        record.n_rows = tx.count()
        files = catalog(spark, args.output)
        record.n_files = files.count()
        missing = [r["path"] for r in missing_outputs(required, existing_outputs(files, args.output)).collect()]
        if missing:
            raise RuntimeError(f"outputs missing: {missing}")
        write_manifest(spark, {"fingerprint": mark}, f"{args.output}/inputs")
    return "written"


if __name__ == "__main__":
    parsed = arguments()
    print(run(build_session(app="preprocess"), parsed))
