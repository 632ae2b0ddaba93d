"""Arguments of the three jobs, and one of them run."""

import pytest

from millrace import __main__ as command_line

SERVER = ["--server", "h", "--database", "d", "--username", "u", "--password", "p"]


def test_extract_arguments():
    args = command_line.arguments(["extract", *SERVER, "--table", "t", "--output-path", "/x"])
    assert (args.table, args.compression, args.partition_by) == ("t", "snappy", [])


def test_credentials_from_the_environment(monkeypatch):
    for name, variable in command_line.ENVIRONMENT.items():
        monkeypatch.setenv(variable, f"my {name}")
    args = command_line.arguments(["restore", "--parquet-path", "/x", "--table-name", "t"])
    assert (args.server, args.if_exists, args.batch_size) == ("my server", "fail", 1000)


@pytest.mark.parametrize(
    "argv",
    [
        ["extract", *SERVER, "--output-path", "/x"],
        ["extract", "--table", "t", "--output-path", "/x"],
        ["restore", *SERVER, "--parquet-path", "/x", "--table-name", "t", "--if-exists", "merge"],
        ["analyze", "--parquet-path", "/x", "--table-name", "t", "--query", "q", "--save-results"],
        [],
    ],
)
def test_wrong_arguments(argv, monkeypatch, capsys):
    for variable in command_line.ENVIRONMENT.values():
        monkeypatch.delenv(variable, raising=False)
    with pytest.raises(SystemExit):
        command_line.arguments(argv)
    assert "error" in capsys.readouterr().err


def test_analyze_runs(spark, folder, capsys):
    args = command_line.arguments(
        [
            "analyze", "--parquet-path", f"{folder}/part.parquet", "--table-name", "parts",
            "--query", "SELECT COUNT(*) AS how_many FROM parts", "--column", "p_type",
        ]
    )
    command_line.run(spark, args)
    shown = capsys.readouterr().out
    assert "analyze: 1 rows in" in shown and "values/p_type" in shown
