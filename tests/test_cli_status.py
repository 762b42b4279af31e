from medallion import fs
from medallion.__main__ import main
from medallion.plans.refine import refine_one


def test_cli_wordcount_and_sql(spark, tmp_ws, capsys):
    fs.touch(spark, f"{tmp_ws}/in/a.txt", "b a\na\n")
    assert main(["wordcount", "--input", f"{tmp_ws}/in", "--output", f"{tmp_ws}/out"], spark=spark) == 0
    got = sorted(r.value for r in spark.read.text(f"{tmp_ws}/out").collect())
    assert got == ["a\t2", "b\t1"]
    assert main(["sql", "SELECT 40 + 2 AS answer"], spark=spark) == 0
    assert "42" in capsys.readouterr().out
    assert not spark.sparkContext._jsc.sc().isStopped()


def test_header_drift_becomes_a_status_row(spark, tmp_ws):
    fs.touch(spark, f"{tmp_ws}/g/f1.csv", "x;y\n1;2\n")
    fs.touch(spark, f"{tmp_ws}/g/f2.csv", "y;x\n3;4\n")
    ds, status, message, cols, n = refine_one(spark, "g", f"{tmp_ws}/g", "csv", f"{tmp_ws}/s/g.parquet")
    assert status == "error" and n is None
    assert "header" in message.lower() and "f2.csv" in message  # the cause, naming the file


def test_workspace_is_the_checkpoint_dir(spark):
    from medallion.session import workspace
    ws = workspace(spark)
    assert ws and ws == (spark.conf.get("spark.checkpoint.dir", None) or ws).rstrip("/")


def test_cli_land_with_options(spark, tmp_ws, capsys):
    import json
    fs.touch(spark, f"{tmp_ws}/src/a.csv", "k;v\n1;x\n2;y\n")
    fs.touch(spark, f"{tmp_ws}/src/b.csv", "k;v\n3;z\n")
    assert main(["land", "--source", f"{tmp_ws}/src", "--bronze", f"{tmp_ws}/bronze",
                 "--checkpoint", f"{tmp_ws}/ck", "--format", "csv", "--schema", "k int, v string",
                 "--option", "header=true", "--option", "sep=;", "--max-files-per-trigger", "1"],
                spark=spark) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report == {"rows": 3, "batches": 2}
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_ws}/bronze").collect()) == [1, 2, 3]
