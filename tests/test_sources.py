"""Scans and sinks on small files."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tarmac.model import CARRIER_REPORT_COLUMNS, FLIGHTS, FLIGHTS_RAW, subset_of
from tarmac.plans import airport, carrier
from tarmac.sources import files, reading, scratch, writing
from tarmac.sources.scratch import scratch_path
from helpers import flight, flights, plan_of, rows_of, write_lines

FEW = subset_of(FLIGHTS_RAW, ("month", "op_unique_carrier", "origin", "arr_delay", "cancelled"))


def kept(spark, path, schema=FEW):
    return rows_of(reading.scan_tolerant(spark, path, schema))


def test_columns_are_found_by_name(spark, tmp_path):
    path = write_lines(
        tmp_path / "f.csv", ["LAX,x,0,7.5,AA,3"], header="origin,other,cancelled,arr_delay,op_unique_carrier,month"
    )
    want = [(3, "AA", "LAX", 7.5, 0)]
    assert kept(spark, path) == want
    assert rows_of(reading.scan_csv(spark, path, FEW)) == want


def test_missing_column_is_named(spark, tmp_path):
    path = write_lines(tmp_path / "f.csv", ["1"], header="month")
    with pytest.raises(ValueError, match="origin"):
        reading.scan_csv(spark, path)


def test_repeated_headers_go(spark, tmp_path):
    header = ",".join(FEW.names)
    path = write_lines(tmp_path / "f.csv", ["1,AA,JFK,2,0", header, "2,AA,JFK,3,0"], header=header)
    assert len(kept(spark, path)) == 2
    assert rows_of(reading.scan_report(spark, path, FEW)) == [("header", 1), ("kept", 2)]


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("1,AA,JFK,2,0", (1, "AA", "JFK", 2.0, 0)),
        ("1.0,AA,JFK,2,1.0", (1, "AA", "JFK", 2.0, 1)),  # whole numbers with a point
        ("1,AA,JFK,2,0.7", (1, "AA", "JFK", 2.0, 0)),  # a status is cut
        ("1.5,AA,JFK,2,0", None),  # a month is not
        ("1,AA,JFK,,0", (1, "AA", "JFK", None, 0)),
        ("1,AA,JFK, ,0", (1, "AA", "JFK", None, 0)),
        ("1,AA,JFK,abc,0", None),
        (",AA,JFK,2,0", None),
        ("1,AA,JFK,2,", None),
        ("1,AA,JFK,2,NaN", None),
        ('1," AA\t"," JFK ",2,0', (1, "AA", "JFK", 2.0, 0)),
        ('1,"A,A","J""K",2,0', (1, "A,A", 'J"K', 2.0, 0)),
        ('"1","AA","JFK","2","0"', (1, "AA", "JFK", 2.0, 0)),
        ("1,AA,JFK,2", None),  # too short
        ("1,AA,JFK,2,0,extra,cells", (1, "AA", "JFK", 2.0, 0)),
        ("1,AA,JFK,abc,0,extra", None),
        ('1,"A,A",JFK,2,0,extra', (1, "A,A", "JFK", 2.0, 0)),
        ("13,AA,JFK,2,0", (13, "AA", "JFK", 2.0, 0)),  # a parsing test only
        ("", None),
    ],
)
def test_lines(spark, tmp_path, line, want):
    path = write_lines(tmp_path / "f.csv", [line], header=",".join(FEW.names))
    assert kept(spark, path) == ([want] if want else [])


def test_short_line_without_unwanted_cells_is_kept(spark, tmp_path):
    path = write_lines(tmp_path / "f.csv", ["1,AA,JFK,2,0"], header=",".join(FEW.names) + ",more")
    assert kept(spark, path) == [(1, "AA", "JFK", 2.0, 0)]


def test_junk_in_an_unwanted_column_does_not_matter(spark, tmp_path):
    path = write_lines(tmp_path / "f.csv", ["1,AA,JFK,late,2,0,,0,,,,,"])
    assert kept(spark, path) == [(1, "AA", "JFK", 2.0, 0)]
    assert kept(spark, path, FLIGHTS_RAW) == []


def test_the_same_lines_go_whichever_columns_a_query_reads(spark, tmp_path):
    path = write_lines(tmp_path / "f.csv", ["1,AA,JFK,late,2,0,,0,,,,,", "1,AA,JFK,1,2,0,,0,,,,,"])
    df = reading.scan_tolerant(spark, path, FLIGHTS_RAW)
    assert df.count() == 1
    assert df.groupBy("origin").count().first()["count"] == 1
    assert df.select("month").collect() == [(1,)]


@pytest.mark.parametrize("header", [True, False])
def test_positional_scan(spark, tmp_path, header):
    lines = ["1,AA,JFK,5,6,0,,0,0,0,0,0,Not Cancelled", "1,AA,JFK,5,x,0,,0,0,0,0,0,Not Cancelled", "1,AA"]
    path = tmp_path / "f.csv"
    path.write_text("\n".join(([",".join(FLIGHTS.names)] if header else []) + lines) + "\n")
    want = [flight(dep_delay=5.0, arr_delay=6.0)]
    assert rows_of(reading.scan_positional(spark, str(path))) == want
    few = subset_of(FLIGHTS, CARRIER_REPORT_COLUMNS)
    assert rows_of(reading.scan_positional(spark, str(path), few)) == [(1, "AA", "JFK", 6.0, 0)]


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    write_lines(tmp_path / "a.csv", ["1,AA,JFK,2,0", "1,AA"], header=",".join(FEW.names))
    write_lines(tmp_path / "b.csv", ["BB,2,JFK,3,x,0", "BB,2,JFK"], header="OP_UNIQUE_CARRIER,MONTH,ORIGIN,ARR_DELAY,MORE,CANCELLED")
    write_lines(tmp_path / "c.csv", ["3,CC,JFK,4,0"], header=",".join(FEW.names))
    (tmp_path / "d.csv").write_text("")
    want = [(1, "AA", "JFK", 2.0, 0), (2, "BB", "JFK", 3.0, 0), (3, "CC", "JFK", 4.0, 0)]
    assert kept(spark, str(tmp_path)) == want
    assert rows_of(reading.scan_csv(spark, str(tmp_path), FEW).filter("cancelled = 0")) == want
    assert rows_of(reading.scan_report(spark, str(tmp_path), FEW)) == [("kept", 3), ("malformed", 2)]
    lines = Observation()
    reading.scan_tolerant(spark, str(tmp_path), FEW, lines).collect()
    assert lines.get == {"lines": 5}


def test_a_file_without_a_wanted_column_is_an_error(spark, tmp_path):
    write_lines(tmp_path / "a.csv", ["1,AA,JFK,2,0"], header=",".join(FEW.names))
    write_lines(tmp_path / "b.csv", ["1,AA,2,0"], header="month,op_unique_carrier,arr_delay,cancelled")
    with pytest.raises(ValueError, match="origin"):
        reading.scan_csv(spark, str(tmp_path), FEW)


def test_no_character_of_a_line_is_taken_for_a_mark(spark, tmp_path):
    lines = ['1,"A\u0001A",JFK,2,0', '1,"\u0002",JFK,2,0', "1,A\u0001\u0002\u0003,JFK,2,0", '1,"A,""B",JFK,2,0', '1,"",JFK,2,0']
    path = write_lines(tmp_path / "f.csv", lines, header=",".join(FEW.names))
    carriers = {row[1] for row in kept(spark, path)}
    assert carriers == {"A\u0001A", "\u0002", "A\u0001\u0002\u0003", 'A,"B', ""}


def test_one_csv_file(spark, tmp_path):
    rows = [flight(origin=f"A{k}", cancellation_code=None) for k in range(50)] + [flight(origin='x,"y')]
    path = tmp_path / "one.csv"
    writing.write_csv_file(flights(spark, *rows).repartition(7), str(path))
    assert path.is_file() and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["one.csv"]
    lines = path.read_text().splitlines()
    assert lines[0] == ",".join(FLIGHTS.names) and len(lines) == 52
    assert rows_of(reading.read_flights(spark, str(path))) == sorted(rows, key=repr)
    writing.write_csv_file(flights(spark).limit(0), str(path))
    assert path.read_text() == ",".join(FLIGHTS.names) + "\n"


def test_one_json_document(spark, tmp_path):
    rows = [flight(op_unique_carrier=c, origin=o) for c in ("ZZ", "AA", "é", 'q"') for o in ("JFK", "LAX")]
    report = carrier.nested_carrier_report(flights(spark, *rows))
    path = tmp_path / "report.json"
    writing.write_report_file(report, str(path))
    found = json.loads(path.read_text())
    assert [d["carrier"] for d in found] == ["AA", "ZZ", 'q"', "é"]
    assert found[0]["airports"][1]["data"]["num_flights"] == 1
    with pytest.raises(FileExistsError):
        writing.write_report_file(report, str(path), mode="errorifexists")
    writing.write_report_file(carrier.nested_carrier_report(flights(spark)), str(path))
    assert json.loads(path.read_text()) == []


def test_one_json_document_goes_through_no_single_task(spark, tmp_path):
    rows = flights(spark, *(flight(op_unique_carrier=f"C{k}") for k in range(40)))
    report = carrier.nested_carrier_report(rows)
    assert "SinglePartition" not in plan_of(writing.in_order(report).select(writing.report_line(report)), "simple")


def test_csv_round_trip(spark, tmp_path):
    rows = [
        flight(), flight(dep_delay=-0.5, arr_delay=1e-7), flight(origin='A,"B"'),
        flight(cancelled=1, dep_delay=None, arr_delay=None, cancellation_code="A"),
    ]
    path = str(tmp_path / "flights.csv")
    writing.write_csv(flights(spark, *rows), path)
    assert rows_of(reading.read_flights(spark, path)) == sorted(rows, key=repr)


def test_table_round_trip_reads_only_wanted_columns(spark, tmp_path):
    path = str(tmp_path / "table")
    writing.write_table(flights(spark, flight()), path)
    df = reading.read_flights(spark, path, subset_of(FLIGHTS, ("month", "origin")))
    assert rows_of(df) == [(1, "JFK")]


def test_report_is_one_ordered_document_per_line(spark, tmp_path):
    df = flights(
        spark, flight(op_unique_carrier="ZZ"), flight(), flight(origin="BOS", cancelled=1, dep_delay=None, arr_delay=None)
    )
    path = tmp_path / "report"
    writing.write_report(carrier.nested_carrier_report(df), str(path))
    lines = [line for part in sorted(path.glob("part-*")) for line in part.read_text().splitlines()]
    documents = [json.loads(line) for line in lines]
    assert [d["carrier"] for d in documents] == ["AA", "ZZ"]
    assert [a["airport"] for a in documents[0]["airports"]] == ["BOS", "JFK"]
    assert documents[0]["airports"][0]["data"] == {
        "num_flights": 1, "arr_delay_min": None, "arr_delay_max": None, "arr_delay_avg": None,
        "cancellation_rate": 1.0, "months": ["January"],
    }


def test_report_mode_can_protect_an_existing_report(spark, tmp_path):
    report = airport.nested_airport_report(flights(spark, flight()))
    path = str(tmp_path / "report")
    writing.write_report(report, path)
    writing.write_report(report, path)
    with pytest.raises(AnalysisException):
        writing.write_report(report, path, mode="errorifexists")


def test_report_line_equals_the_written_line(spark, tmp_path):
    report = carrier.nested_carrier_report(flights(spark, flight()))
    path = tmp_path / "report"
    writing.write_report(report, str(path))
    (line,) = [line for part in path.glob("part-*") for line in part.read_text().splitlines()]
    assert report.select(writing.report_line(report)).first()[0] == line


class Session:
    """As much of a session as choosing a scratch folder needs."""

    def __init__(self, setting, master="local[2]"):
        self.setting, self.master, self.chosen = setting, master, None
        self.conf = self.sparkContext = self

    def get(self, name, default):
        return self.setting if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.chosen

    def setCheckpointDir(self, folder):
        self.chosen = folder


def test_scratch_folder_comes_from_the_session(monkeypatch):
    monkeypatch.setattr(scratch, "_MADE", [])
    session = Session("hdfs://shared/folder/", master="yarn")
    assert scratch_path(session, "x").startswith("hdfs://shared/folder/x-")
    assert scratch_path(session, "x") != scratch_path(session, "x")


def test_scratch_folder_is_local_only_in_local_mode(monkeypatch):
    monkeypatch.setattr(scratch, "_MADE", [])
    session = Session(None)
    assert scratch_path(session, "x").startswith(f"{session.chosen}/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(None, master="yarn"), "x")


def test_scratch_tables_are_removed_on_request(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_MADE", [])
    paths = [scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "y") + ".csv", scratch.scratch_path(spark, "z")]
    for path in paths[:2]:
        spark.range(3).write.parquet(path)
    assert scratch.remove_scratch(spark) == 2 and scratch.remove_scratch(spark) == 0
    assert not any(files.exists(spark, path) for path in paths)


def test_blank_keys_are_dropped_before_a_report(spark, tmp_path):
    from tarmac.operators.cleaning import drop_empty_keys, normalize_strings

    header = ",".join(FEW.names)
    path = write_lines(tmp_path / "f.csv", ['1,"  ",JFK,2,0', "1,,JFK,2,0", "1,AA,,2,0", "1,AA,JFK,2,0"], header=header)
    df = drop_empty_keys(reading.scan_tolerant(spark, path, FEW))
    assert df.agg(F.count("*")).first()[0] == 1


def test_text_columns_alone(spark, tmp_path):
    path = write_lines(tmp_path / "f.csv", ["1,AA,JFK,2,0", "1"], header=",".join(FEW.names))
    assert kept(spark, path, subset_of(FLIGHTS_RAW, ("op_unique_carrier", "origin"))) == [("AA", "JFK")]


def test_short_lines_go_even_if_the_file_has_more_columns(spark, tmp_path):
    header = "month,cancelled,op_unique_carrier,origin,arr_delay,more,and_more"
    lines = ["1,0,AA,JFK,2,x,y", "1,0,AA,JFK,3", "1,0,AA,JFK", "1,0,AA"]
    path = write_lines(tmp_path / "f.csv", lines, header=header)
    assert kept(spark, path) == [(1, "AA", "JFK", 2.0, 0), (1, "AA", "JFK", 3.0, 0)]
    assert rows_of(reading.scan_report(spark, path, FEW)) == [("kept", 2), ("malformed", 2)]
    assert reading.scan_tolerant(spark, path, FEW).select("month").count() == 2


@pytest.mark.parametrize(
    ("line", "keeps"),
    [
        ("1,AA,JFK,2,0" + "," * 30_000, True),
        ('1,"AA","JFK",2,0' + ',"x,y"' * 50_000, True),
        ('1,"AA,JFK,2,0', False),  # never closed
        ("1,AA,JFK,2,0," + "x" * 1_000_000, True),
        ("1," + "A" * 1_000_000 + ",JFK,2,0", True),
        ('"' * 100_001, False),
        ("1,AA,JFK,5d,0", False),
        ("1,AA,JFK,6f,0", False),
        ("1,AA,JFK,0x1p3,0", False),
    ],
)
def test_no_line_fails_the_scan(spark, tmp_path, line, keeps):
    path = write_lines(tmp_path / "f.csv", ["1,BB,JFK,2,0", line], header=",".join(FEW.names))
    df = reading.scan_tolerant(spark, path, FEW)
    assert df.count() == 1 + keeps
    assert rows_of(reading.scan_report(spark, path, FEW)) == ([("kept", 2)] if keeps else [("kept", 1), ("malformed", 1)])


def test_text_columns_alone_can_be_counted(spark, tmp_path):
    path = write_lines(tmp_path / "f.csv", ["1,AA,JFK,2,0", "1"], header=",".join(FEW.names))
    assert reading.scan_tolerant(spark, path, subset_of(FLIGHTS_RAW, ("op_unique_carrier", "origin"))).count() == 1


def test_headers_without_regard_to_case(spark, tmp_path):
    path = write_lines(tmp_path / "f.csv", ["1,AA,JFK,2,0"], header=",".join(FEW.names).upper())
    assert kept(spark, path) == rows_of(reading.scan_csv(spark, path, FEW)) == [(1, "AA", "JFK", 2.0, 0)]
    path = write_lines(tmp_path / "g.csv", ["1,1,AA,JFK,2,0"], header="MONTH," + ",".join(FEW.names))
    with pytest.raises(ValueError, match="header"):
        reading.scan_tolerant(spark, path, FEW)


def test_compressed_text_and_other_names(spark, tmp_path):
    path = str(tmp_path / "flights")
    writing.write_csv(flights(spark, flight()), path)
    assert rows_of(reading.read_flights(spark, path, form="csv")) == [flight()]


def test_tabs_are_blanks_on_either_path(spark):
    from tarmac.operators.cleaning import drop_empty_keys, normalize_strings

    rows = flights(spark, flight(op_unique_carrier="AA\t"), flight(op_unique_carrier="\t"), flight())
    assert [r.op_unique_carrier for r in normalize_strings(drop_empty_keys(rows)).collect()] == ["AA", "AA"]
