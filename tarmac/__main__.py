"""Command line: ``spark-submit run.py <command> ...`` or ``python -m tarmac <command> ...``.

prepare RAW.csv OUT          clean table OUT/clean, subsets OUT/input; prints the quality report
carrier-report FLIGHTS OUT   one JSON document per carrier
airport-report FLIGHTS OUT   one JSON document per airport
add-states KIND FLIGHTS OUT  states of a batch of flights, from which --states reports without reading the flights again

FLIGHTS is a clean table: a Parquet directory, or delimited text whose path ends in .csv or .csv.gz;
--format says which it is under any other name. Of text, both reports print how many lines they dropped.
"""

from __future__ import annotations

import argparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac import model
from tarmac.operators.cleaning import drop_empty_keys
from tarmac.operators.subsets import random_draw, record_draw, stored
from tarmac.plans import states
from tarmac.plans.airport import nested_airport_report
from tarmac.plans.carrier import nested_carrier_report
from tarmac.plans.prepare import write_clean, write_shuffled, write_subsets
from tarmac.plans.quality import rows_by, top_carriers, top_origins
from tarmac.sources.reading import is_text, read_flights, read_rung, scan_report, scan_tolerant
from tarmac.sources.scratch import remove_scratch
from tarmac.sources.writing import write_report, write_report_file


def parse_arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tarmac", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)

    prepare = commands.add_parser("prepare")
    prepare.add_argument("raw")
    prepare.add_argument("out")
    prepare.add_argument("--seed", type=int, default=model.SUBSET_SEED)
    prepare.add_argument("--exact", action="store_true", help="subsets of exactly the given sizes")
    prepare.add_argument(
        "--size", action="append", metavar="NAME=ROWS", help="subset to cut (default: 500k, 1M, 3M, 5M)"
    )
    prepare.add_argument("--shuffle", action="store_true", help="write OUT/shuffled too; subsets are its first rows")
    prepare.add_argument(
        "--layout", choices=["folders", "files", "nested"], default="folders",
        help="subsets as folders, as single files, or as folders that share their rows (read with --subset)",
    )
    for name in ("carrier-report", "airport-report"):
        report = commands.add_parser(name)
        report.add_argument("flights")
        report.add_argument("out")
        report.add_argument("--keep-existing", action="store_true", help="fail if OUT is there already")
        report.add_argument("--format", choices=["csv", "parquet"], help="what FLIGHTS is, whatever its name")
        report.add_argument("--subset", metavar="NAME", help="of the nested subsets in the folder FLIGHTS")
        report.add_argument("--states", action="store_true", help="FLIGHTS is a folder that add-states has written")
        report.add_argument("--single-file", action="store_true", help="OUT is one file that holds a JSON array")
    add = commands.add_parser("add-states")
    add.add_argument("kind", choices=["carrier", "airport"])
    add.add_argument("flights")
    add.add_argument("out")
    add.add_argument("--batch", required=True, help="name of the batch; a batch of that name is replaced")
    add.add_argument("--format", choices=["csv", "parquet"], help="what FLIGHTS is, whatever its name")
    for bands in (commands.choices["airport-report"], add):
        bands.add_argument("--low-below", type=float, default=model.LOW_BELOW)
        bands.add_argument("--high-above", type=float, default=model.HIGH_ABOVE)
        bands.add_argument("--ungated", action="store_true", help="count cancellation reasons of operated flights too")
    top = commands.choices["airport-report"]
    top.add_argument("--top", type=int, default=3, metavar="K", help="causes per month (default: 3)")
    return parser.parse_args(argv)


def prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    sizes = model.SUBSET_SIZES
    if args.size:
        sizes = {name: int(rows) for name, rows in (size.split("=") for size in args.size)}
    lines = Observation("lines")
    raw = scan_tolerant(spark, args.raw, model.FLIGHTS_RAW, lines)
    draw = record_draw(model.FLIGHTS.names, args.seed) if args.exact else random_draw(args.seed)
    funnel = write_clean(raw, f"{args.out}/clean", draw, lines)
    for step, rows in funnel.items():
        print(f"{step:20} {rows:>15,}")
    read, kept = funnel["raw"], list(funnel.values())[-1]
    share = f" ({(read - kept) / read:.1%})" if read else ""
    print(f"{'removed':20} {read - kept:>15,}{share}")
    flights = spark.read.parquet(f"{args.out}/clean")
    rows_by(flights, "month").show()
    top_carriers(flights).show()
    top_origins(flights).show()
    table = f"{args.out}/clean"
    if args.shuffle:
        table = f"{args.out}/shuffled"
        write_shuffled(spark, f"{args.out}/clean", table, args.seed, stored(draw))
    subsets = write_subsets(
        spark, table, f"{args.out}/input", sizes, args.seed, args.exact, stored(draw), args.layout
    )
    for name, rows in subsets.items():
        print(f"flight_{name}.csv {rows:>15,}")


def kind_of_states(args: argparse.Namespace, carrier: bool) -> states.Kind:
    return states.CARRIER if carrier else states.airport_kind(args.low_below, args.high_above, not args.ungated)


def add_states(spark: SparkSession, args: argparse.Namespace) -> None:
    carrier = args.kind == "carrier"
    columns = model.CARRIER_REPORT_COLUMNS if carrier else model.AIRPORT_REPORT_COLUMNS
    kind = kind_of_states(args, carrier)
    flights = read_flights(spark, args.flights, model.subset_of(model.FLIGHTS, columns), args.format)
    states.add_batch(states.states(drop_empty_keys(flights, kind.text_keys), kind), args.out, args.batch)


def report_from_states(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    carrier = args.command == "carrier-report"
    found = states.stored(spark, args.flights, kind_of_states(args, carrier))
    return states.nested_carrier_report(found) if carrier else states.nested_airport_report(found, args.top)


def line_counts(spark: SparkSession, path: str, schema, lines: Observation, parsed: Observation) -> tuple[int, int]:
    """Lines read and lines kept, as observed while the report was written.

    Spark loses what it observed if no row is left for the report, because it then drops the
    plan; only such files are read a second time.
    """
    try:
        return lines.get["lines"], parsed.get["lines"]
    except Py4JJavaError:
        counts = {row.status: row.lines for row in scan_report(spark, path, schema).collect()}
        return sum(counts.values()), counts.get("kept", 0)


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = parse_arguments(argv)
    spark = spark or SparkSession.builder.appName(f"tarmac {args.command}").getOrCreate()
    if args.command == "prepare":
        try:
            prepare(spark, args)
        finally:
            remove_scratch(spark)
        return
    if args.command == "add-states":
        add_states(spark, args)
        return
    mode = "errorifexists" if args.keep_existing else "overwrite"
    write = write_report_file if args.single_file else write_report
    if args.states:
        write(report_from_states(spark, args), args.out, mode)
        return
    if args.command == "carrier-report":
        columns = model.CARRIER_REPORT_COLUMNS
        keys = ("op_unique_carrier", "origin")
        report = nested_carrier_report
    else:
        columns = model.AIRPORT_REPORT_COLUMNS
        keys = ("origin",)

        def report(flights):
            return nested_airport_report(flights, args.low_below, args.high_above, args.top, not args.ungated)

    lines, parsed = Observation("lines"), Observation("parsed")
    schema = model.subset_of(model.FLIGHTS, columns)
    if args.subset:
        flights = read_rung(spark, args.flights, args.subset, schema, lines)
        text = False
    else:
        flights = read_flights(spark, args.flights, schema, args.format, lines)
        text = is_text(args.flights, args.format)
    if text:
        flights = flights.observe(parsed, F.count("*").alias("lines"))
    write(report(drop_empty_keys(flights, keys)), args.out, mode)
    if text:
        read, kept = line_counts(spark, args.flights, schema, lines, parsed)
        print(f"{'lines':20} {read:>15,}\n{'dropped':20} {read - kept:>15,}")


if __name__ == "__main__":
    main()
