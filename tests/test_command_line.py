"""The commands on a small raw file."""

import json

import pytest

from tarmac import binding
from tarmac.__main__ import main
from tarmac.model import FLIGHTS
from tarmac.operators.subsets import DRAW
from tarmac.plans.prepare import write_clean
from tarmac.plans.quality import cleaning_funnel
from tarmac.sources.writing import write_csv
from helpers import HEADER, rows_of, write_lines


@pytest.fixture(scope="module")
def out(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cli")
    write_csv(binding.flights_raw(spark, sf_dir), str(folder / "raw.csv"))
    main(["prepare", str(folder / "raw.csv"), str(folder), "--size", "1k=1000", "--size", "9k=9000"], spark)
    return folder


def documents(path):
    return [json.loads(line) for part in sorted(path.glob("part-*")) for line in part.read_text().splitlines()]


def test_prepare_writes_table_and_subsets(spark, sf_dir, out):
    table = spark.read.parquet(str(out / "clean"))
    assert table.columns == [*FLIGHTS.names, DRAW]  # the draw stays with the table, for repeatable subsets
    assert rows_of(table.drop(DRAW)) == rows_of(binding.flights(spark, sf_dir))
    assert spark.read.csv(str(out / "input" / "flight_1k.csv"), header=True).columns == FLIGHTS.names
    assert sorted(p.name for p in (out / "input").iterdir()) == ["flight_1k.csv", "flight_full.csv"]


def test_prepare_prints_the_quality_report(spark, out, tmp_path, capsys):
    main(["prepare", str(out / "raw.csv"), str(tmp_path), "--size", "1k=1000", "--exact"], spark)
    lines = [line.split() for line in capsys.readouterr().out.splitlines()]
    assert ["raw", "6,000"] in lines and ["keys_not_blank", "5,164"] in lines
    assert ["removed", "836", "(13.9%)"] in lines
    assert ["flight_1k.csv", "1,000"] in lines and ["flight_full.csv", "5,164"] in lines


def test_prepare_drops_lines_with_junk(spark, tmp_path, capsys):
    fields = dict.fromkeys(HEADER.split(","), "0") | {"month": "1", "op_unique_carrier": "AA", "origin": "JFK"}
    good = ",".join(fields.values())
    junk = ",".join((fields | {"carrier_delay": "abc"}).values())
    raw = write_lines(tmp_path / "raw.csv", [good, junk, good, "1,AA"])
    main(["prepare", raw, str(tmp_path / "out"), "--size", "1=1"], spark)
    lines = [line.split() for line in capsys.readouterr().out.splitlines()]
    assert ["raw", "4"] in lines and ["parsed", "2"] in lines and ["keys_not_blank", "2"] in lines
    assert ["flight_full.csv", "2"] in lines


def test_counts_taken_while_writing_equal_the_funnel(spark, sf_dir, tmp_path):
    raw = binding.flights_raw(spark, sf_dir)
    want = {row.step: row.rows for row in cleaning_funnel(raw).collect()}
    assert write_clean(raw, str(tmp_path / "clean")) == want


@pytest.mark.parametrize("source", ["clean", "input/flight_full.csv"])
def test_reports_from_table_and_text(out, tmp_path, source):
    main(["carrier-report", str(out / source), str(tmp_path / "carrier")])
    main(["airport-report", str(out / source), str(tmp_path / "airport")])
    carriers, airports = documents(tmp_path / "carrier"), documents(tmp_path / "airport")
    assert [d["carrier"] for d in carriers] == ["AF", "AO", "NF", "NO", "RF", "RO"]
    assert sum(len(d["airports"]) for d in carriers) == 60
    assert len(airports) == 10 and sum(len(d["months"]) for d in airports) == 116
    assert sum(a["data"]["num_flights"] for d in carriers for a in d["airports"]) == 5164


def test_band_limits_are_options(out, tmp_path):
    main(["airport-report", str(out / "clean"), str(tmp_path / "r"), "--low-below", "1000", "--high-above", "1000"])
    bands = [m["bands"] for d in documents(tmp_path / "r") for m in d["months"]]
    assert sum(b["low"]["count"] for b in bands) == 1389 + 1496 + 2005
    assert all(b[n] == {"count": 0, "avg_dep_delay": None, "avg_arr_delay": None} for b in bands for n in ("medium", "high"))


def test_crossing_band_limits_are_refused(out, tmp_path):
    with pytest.raises(ValueError, match="two bands"):
        main(["airport-report", str(out / "clean"), str(tmp_path / "r"), "--low-below", "1000"])


def test_existing_report_can_be_kept(out, tmp_path):
    main(["carrier-report", str(out / "clean"), str(tmp_path / "r")])
    with pytest.raises(Exception, match="(?i)exists"):
        main(["carrier-report", str(out / "clean"), str(tmp_path / "r"), "--keep-existing"])


def test_reports_say_how_many_lines_they_drop(spark, tmp_path, capsys):
    fields = dict.fromkeys(FLIGHTS.names, "0") | {"month": "1", "op_unique_carrier": "AA", "origin": "JFK"}
    good = ",".join(fields.values())
    junk = ",".join((fields | {"arr_delay": "abc"}).values())
    raw = write_lines(tmp_path / "raw.csv", [good, junk, good, "1,AA"], ",".join(FLIGHTS.names))
    for command in ("carrier-report", "airport-report"):
        main([command, raw, str(tmp_path / command)], spark)
        assert [line.split() for line in capsys.readouterr().out.splitlines()] == [["lines", "4"], ["dropped", "2"]]
    for name, rows in {"empty": [], "broken": ["1,AA", junk]}.items():
        raw = write_lines(tmp_path / f"{name}.csv", rows, ",".join(FLIGHTS.names))
        main(["carrier-report", raw, str(tmp_path / name)], spark)
        assert capsys.readouterr().out.split() == ["lines", str(len(rows)), "dropped", str(len(rows))]


def test_format_top_and_ungated_are_options(spark, tmp_path):
    fields = dict.fromkeys(FLIGHTS.names, "0") | {
        "month": "1", "op_unique_carrier": "AA", "origin": "JFK", "carrier_delay": "5", "weather_delay": "5"
    }
    flown = ",".join((fields | {"cancellation_reason": "Security"}).values())
    raw = write_lines(tmp_path / "flights.txt", [flown], ",".join(FLIGHTS.names))
    found = {}
    for name, options in {"default": [], "one": ["--top", "1"], "ungated": ["--ungated"]}.items():
        main(["airport-report", raw, str(tmp_path / name), "--format", "csv", *options], spark)
        ((month,),) = ([d["months"] for d in documents(tmp_path / name)])
        found[name] = len(month["top_3_causes"])
    assert found == {"default": 2, "one": 1, "ungated": 3}


def test_prepare_with_a_shuffle_and_single_files(spark, out, tmp_path, capsys):
    main(["prepare", str(out / "raw.csv"), str(tmp_path), "--size", "1k=1000", "--size", "2k=2000", "--shuffle", "--layout", "files"], spark)
    lines = [line.split() for line in capsys.readouterr().out.splitlines()]
    assert ["flight_1k.csv", "1,000"] in lines and ["flight_2k.csv", "2,000"] in lines
    assert sorted(p.name for p in (tmp_path / "input").iterdir() if p.is_file() and not p.name.startswith(".")) == [
        "flight_1k.csv", "flight_2k.csv", "flight_full.csv",
    ]
    texts = {n: (tmp_path / "input" / f"flight_{n}.csv").read_text().splitlines() for n in ("1k", "2k", "full")}
    assert [len(t) for t in texts.values()] == [1001, 2001, 5165]
    assert {t[0] for t in texts.values()} == {",".join(FLIGHTS.names)}
    first = {r.position for r in spark.read.parquet(str(tmp_path / "shuffled")).collect()}
    assert first == set(range(5164))


def test_reports_from_nested_subsets(spark, out, tmp_path):
    main(["prepare", str(out / "raw.csv"), str(tmp_path), "--size", "1k=1000", "--exact", "--layout", "nested"], spark)
    folder = str(tmp_path / "input")
    main(["carrier-report", folder, str(tmp_path / "all.json"), "--subset", "full", "--single-file"])
    main(["carrier-report", folder, str(tmp_path / "some.json"), "--subset", "1k", "--single-file"])
    for name, flights in (("all", 5164), ("some", 1000)):
        report = json.loads((tmp_path / f"{name}.json").read_text())
        assert sum(a["data"]["num_flights"] for d in report for a in d["airports"]) == flights
    with pytest.raises(ValueError, match="no subset"):
        main(["carrier-report", folder, str(tmp_path / "r"), "--subset", "9k"])
    with pytest.raises(FileExistsError):
        main(["carrier-report", folder, str(tmp_path / "all.json"), "--subset", "1k", "--single-file", "--keep-existing"])


def test_states_of_batches_give_the_reports_of_all_flights(spark, out, tmp_path):
    halves = [spark.read.parquet(str(out / "clean")).filter(test) for test in ("month <= 6", "month > 6")]
    for name, half in zip(("first", "second"), halves):
        half.write.parquet(str(tmp_path / name))
        for kind in ("carrier", "airport"):
            for _ in range(2):  # a repeated batch counts once
                main(["add-states", kind, str(tmp_path / name), str(tmp_path / f"{kind}-states"), "--batch", name])
    for kind in ("carrier", "airport"):
        main([f"{kind}-report", str(out / "clean"), str(tmp_path / f"{kind}-1")])
        main([f"{kind}-report", str(tmp_path / f"{kind}-states"), str(tmp_path / f"{kind}-2"), "--states"])
        assert documents(tmp_path / f"{kind}-1") == documents(tmp_path / f"{kind}-2") != []
