"""Named CSV files: round trip, names, pieces, failed tasks."""

import os

import pytest
from pyspark.sql import functions as F

from stayframe.sources.files import read_param_files
from stayframe.sources.named_csv import BOM, write_named_csv

SCHEMA = "i long, v double, t string"
INDEXED = "idx long, i long, v double, t string"
ODD = ["heart rate", "a/b", "é%20x", ".dot", "_u", "x~1", "p+q", "a=b", None, "c.d.csv", "*q", "a:b,(c)", "50%", "~null", "in_side", " lead"]


def made(spark, names=ODD, n=5):
    rows = [(i, p, float(i), f'say "{i}", é' if i % 3 else ("" if i % 2 else None)) for p in names for i in range(n)]
    return spark.createDataFrame(rows, "i long, p string, v double, t string")


def same(back, df):
    df = df.withColumn("t", F.when(F.col("t") != "", F.col("t")))      # CSV does not tell an empty text from none
    got, want = (sorted(map(str, x.select("i", "p", "v", "t").collect())) for x in (back, df))
    assert got == want


@pytest.mark.parametrize("scheme", ["", "file://"])
@pytest.mark.parametrize("pieces", [None, 2])
def test_round_trip_of_odd_names(spark, tmp_path, scheme, pieces):
    df = made(spark)
    path = scheme + str(tmp_path / "out")
    os.mkdir(tmp_path / "out")
    write_named_csv(df, path, "p", index=True, bom=True, order=("i",), rows_per_file=pieces)
    files = os.listdir(tmp_path / "out")
    assert all(f.endswith(".csv") for f in files) and (len(files) == len(ODD)) == (pieces is None)
    # dot-files and other files are not read
    for other in (".hidden.csv", "notes.txt", "_x.csv"):
        (tmp_path / "out" / other).write_text("nothing")
    same(read_param_files(spark, path, INDEXED, "p", from_="file", drop=["idx"]), df)
    index = read_param_files(spark, path, INDEXED, "p", from_="file")
    if pieces is None:
        assert index.where("idx <> i").isEmpty()
    raw = (tmp_path / "out" / "heart rate.csv").read_bytes()
    assert raw.startswith(BOM + b'"","i","v","t"\n')


def test_plain_files_and_files_from_elsewhere(spark, tmp_path):
    df = made(spark, ["a b", "c+d"], 3)
    path = str(tmp_path / "out")
    write_named_csv(df, path, "p")
    assert sorted(os.listdir(path)) == ["a b.csv", "c%2Bd.csv"]
    assert (tmp_path / "out" / "a b.csv").read_bytes().startswith(b'"i","v","t"\n')
    for name in ("c+d 2.csv", "100%.csv"):
        (tmp_path / "out" / name).write_text("i,v,t\n7,1.5,x\n")
    got = {(r.p, r.i) for r in read_param_files(spark, path, SCHEMA, "p", from_="file").where("i = 7").collect()}
    assert got == {("c+d 2", 7), ("100%", 7)}
    # a further write replaces its own files only
    write_named_csv(df.where("p = 'a b' AND i = 0"), path, "p")
    left = read_param_files(spark, path, SCHEMA, "p", from_="file")
    assert {r.p: r.n for r in left.groupBy("p").agg(F.count("*").alias("n")).collect()} == {"a b": 1, "c+d": 3, "c+d 2": 1, "100%": 1}


def test_no_rows_and_a_failed_write_leave_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    write_named_csv(made(spark).limit(0), path, "p")
    assert not os.path.exists(path) or os.listdir(path) == []
    bad = made(spark).withColumn("v", F.when(F.col("i") == 4, F.raise_error(F.lit("no")).cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        write_named_csv(bad, path, "p")
    assert not os.path.exists(path) or os.listdir(path) == []


def test_a_hot_parameter_is_cut_into_pieces(spark, tmp_path):
    df = made(spark, ["hot"], 1000).unionByName(made(spark, ["cold"], 10))
    path = str(tmp_path / "out")
    write_named_csv(df, path, "p", rows_per_file=100)
    files = sorted(os.listdir(path))
    assert len([f for f in files if f.startswith("hot")]) == 10 and "cold.csv" in files
    assert max(len((tmp_path / "out" / f).read_text().splitlines()) for f in files) < 200
    same(read_param_files(spark, path, SCHEMA, "p", from_="file"), df)
