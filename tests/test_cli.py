from __future__ import annotations

from blotter.cli import main
from blotter.session import scratch_path
from tests.conftest import csv_text


def test_cli_reports_run_on_every_input_format(spark, incident_files, tmp_path, capsys):
    f1, f2 = incident_files
    geo = tmp_path / "geo.csv"
    geo.write_text(csv_text([["34.05", "-118.25", "90012;90013"], ["34.10", "-118.20", "90001"]],
                            ["LAT", "LON", "ZIPcode"]))
    income = tmp_path / "income.csv"
    income.write_text(csv_text([["90012", "A", "$90,000"], ["90001", "B", "$20,000"]],
                               ["Zip Code", "Community", "Estimated Median Income"]))
    stations = tmp_path / "stations.csv"
    stations.write_text(csv_text([["-118.25", "34.05", "1", "Central", "x", "1"],
                                  ["-118.30", "34.10", "2", "Rampart", "y", "2"]],
                                 ["X", "Y", "FID", "DIVISION", "LOCATION", "PREC"]))
    parquet = scratch_path(spark, "cli-etl")
    assert main(["csv-to-parquet", "--src", f1, f2, "--dst", parquet]) == 0
    for fmt, paths in [("csv", [f1, f2]), ("text", [f1, f2]), ("parquet", [parquet])]:
        assert main(["top-months", "--incidents", *paths, "--format", fmt]) == 0
        assert main(["day-bands", "--incidents", *paths, "--format", fmt, "--sql"]) == 0
    out = capsys.readouterr().out
    assert out.count("|2015|1    |2          |1      |") == 3
    assert main(["income-profile", "--incidents", f1, f2, "--geo", str(geo), "--income", str(income),
                 "-k", "1", "--strategy", "broadcast"]) == 0
    assert main(["station-profile", "--incidents", f1, f2, "--stations", str(stations), "--strategy", "merge",
                 "--salt", "4"]) == 0
    out = capsys.readouterr().out
    assert "Rampart" in out and "White" in out
    typed = scratch_path(spark, "cli-etl-typed")
    assert main(["csv-to-parquet", "--src", f1, f2, "--dst", typed, "--typed"]) == 0
    assert main(["income-profile", "--incidents", typed, "--format", "parquet", "--geo", str(geo),
                 "--income", str(income), "-k", "1", "--end", "both"]) == 0
    out = capsys.readouterr().out
    assert "bottom" in out and "top" in out
