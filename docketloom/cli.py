"""docketloom SLUG --landing DIR --out DIR: run one dataset over landed frames to its wide CSV; with --collect, fetch them first.

The landing folder holds one Parquet, JSON-lines or TSV source for each input of the dataset, by its name (``--list`` shows them);
``--harvest FILE`` is the input ``harvest`` of the datasets that have one. An output of an earlier run is replaced only if every guard
of the dataset holds. Exit codes: 0 done, 1 nothing to do, 2 no such dataset or collector.
"""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .plans import cases, collect, dataset, feeds, layouts, listings  # noqa: F401  (registers the datasets)
from .ship import ship
from .sources import landing
from .sources.paging import Fetcher


def load(spark: SparkSession, spec: dataset.Dataset, folder: str | None, harvest: str | None) -> dict[str, DataFrame]:
    """The dataset's inputs; one that isn't there is empty."""
    frames = {}
    for name, schema in spec.inputs.items():
        if name == "harvest" and harvest:
            frames[name] = landing.read_harvest_tsv(spark, harvest, tuple(c.split()[0] for c in schema.split(", "))) if harvest.endswith(".tsv") else landing.read_harvest_jsonl(spark, harvest, schema)
            continue
        found = [p for p in (Path(folder or "", f"{name}.{kind}") for kind in ("parquet", "jsonl", "json")) if folder and p.exists()]
        if not found:
            frames[name] = spark.createDataFrame([], schema)
        elif found[0].suffix == ".parquet":
            frames[name] = spark.read.parquet(str(found[0]))
        else:
            frames[name] = spark.read.schema(schema).json(str(found[0]))
    return frames


def main(argv: list[str] | None = None, fetcher: Fetcher = landing.fetch, delay: float = 0.3) -> int:
    parser = argparse.ArgumentParser(prog="docketloom", description="Run a dataset over landed documents to a wide CSV.")
    parser.add_argument("slug", nargs="?", help="dataset; leave out with --list")
    parser.add_argument("--landing", help="folder with the dataset's inputs")
    parser.add_argument("--harvest", help="harvest file (JSON lines or TSV) of datasets that read one")
    parser.add_argument("--collect", action="store_true", help="fetch the inputs first, into the landing folder (default: one in the output folder); what is there is not fetched again")
    parser.add_argument("--out", default="out", help="output folder (default: out)")
    parser.add_argument("--as-of", help="day that plausible years are counted from (default: today)")
    parser.add_argument("--staging", help="folder for the parsed rows, which guards, order and sink read and which go afterwards (default: that of the output)")
    parser.add_argument("--parts", action="store_true", help="write a folder of part files in order, not a single one")
    parser.add_argument("--list", action="store_true", help="list datasets and their inputs")
    args = parser.parse_args(argv)
    if args.list or not args.slug:
        for slug, spec in sorted(dataset.REGISTRY.items()):
            print(f"{slug:40} {spec.description} [{', '.join(spec.inputs)}]")
        if not args.list:
            print("\nName a dataset, or use --list.", file=sys.stderr)
        return 0 if args.list else 1
    try:
        spec = dataset.get(args.slug)
    except KeyError:
        print(f"No such dataset: {args.slug}; --list shows all.", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName(f"docketloom {spec.slug}").getOrCreate()
    ship(spark)
    now = datetime.now(UTC).replace(microsecond=0)
    target = f"{args.out}/{spec.csv_name}"
    as_of = args.as_of or now.date().isoformat()
    if args.collect:
        if spec.slug not in collect.COLLECTORS:
            print(f"{spec.slug} can't be collected; land its inputs. Can be: {', '.join(sorted(collect.COLLECTORS))}", file=sys.stderr)
            return 2
        frames = collect.frames(spark, spec.slug, args.landing or f"{args.out}/_landing/{spec.slug}", as_of, fetcher, delay)
    else:
        frames = load(spark, spec, args.landing, args.harvest)
    n = spec.publish(frames, target, now.isoformat(), as_of, single=not args.parts, staging=args.staging)
    print(f"Wrote {n} rows to {target}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
