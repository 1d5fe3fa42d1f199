import importlib.util
import os


_spec = importlib.util.spec_from_file_location(
    "flatlake_cli", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts", "flatlake_cli.py")
)
cli = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(cli)


def test_cli_commands(spark, bucket, tmp_path, capsys):
    assert cli.main(["list-formats"]) == 0
    assert "parquet" in capsys.readouterr().out
    assert cli.main(["list-datasets", "-s", bucket]) == 0
    out = capsys.readouterr().out
    assert "us_options_opra/quotes_v1\t(options/quotes)" in out
    assert cli.main(["list-dates", "-s", bucket, "-d", "options/quotes", "--year", "2024", "--month", "11"]) == 0
    assert capsys.readouterr().out.count(".csv.gz") == 2
    dest = str(tmp_path / "out")
    code = cli.main(["pull", "-s", bucket, "-o", dest, "-d", "options/quotes", "--start-date", "2024-11-05",
                     "--end-date", "2024-11-29", "--ticker-prefix", "O:ZED", "--columns", "ticker,sip_timestamp"])
    assert code == 0
    assert "written: 2" in capsys.readouterr().out
    assert cli.main(["pull", "-s", bucket, "-o", dest, "-d", "options/quotes", "--start-date", "2024-11-05",
                     "--end-date", "2024-11-29", "--ticker-prefix", "O:ZED", "--columns", "ticker,sip_timestamp"]) == 0
    assert "skipped: 2" in capsys.readouterr().out
