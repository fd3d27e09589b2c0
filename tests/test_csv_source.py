"""A1: session CSV files, checked per file and per line."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import contract as C
from cartwheel.schema import EXPECTED_COLUMNS
from cartwheel.sources.csv_sessions import HEADER, load_sessions_csv, write_lines
from cartwheel.sources.sessions import load_sessions
from tests.conftest import SF_SMALL

LINE = "1,1.0,1,1.0,1,1.0,0.2,0.2,0.0,0.0,Feb,1,1,1,1,Returning_Visitor,FALSE,FALSE"


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w", newline="") as out:
            out.write(text)
    return folder


def test_round_trip_through_the_contract(spark, tmpdir_path):
    s = load_sessions(spark, SF_SMALL).select(*EXPECTED_COLUMNS)
    s.repartition(3).write.option("header", True).csv(f"{tmpdir_path}/csv")
    found = load_sessions_csv(spark, f"{tmpdir_path}/csv")
    assert found.rows.columns == list(EXPECTED_COLUMNS) and found.quarantine.count() == 0
    assert found.files.count() == 3 and found.files.where("not header_ok").count() == 0
    valid = C.validate(found.rows, strict=True).valid
    assert valid.count() == s.count()
    assert valid.exceptAll(s).count() == 0 and s.exceptAll(valid).count() == 0


def test_files_and_lines_are_checked(spark, tmpdir_path):
    wrong = HEADER.replace("Month", "Monat")
    folder = put(f"{tmpdir_path}/in", good=f"{HEADER}\r\n{LINE}\r\n\r\n{LINE},9\n{LINE[:-6]}\n\"{LINE}\n{LINE}", other=f"{wrong}\n{LINE}\n{LINE}\n",
                 late=f"{LINE}\n{HEADER}\n{LINE}\n", only=f"{HEADER}\n", empty="")
    found = load_sessions_csv(spark, folder)
    assert found.rows.count() == 2 and found.rows.where("Revenue <> 'FALSE'").count() == 0
    per = {(os.path.basename(r["file"]), r["reason"]): r["n"] for r in found.quarantine.groupBy("file", "reason").agg(F.count("*").alias("n")).collect()}
    assert per == {("good.csv", "malformed"): 3, ("other.csv", "header"): 3, ("late.csv", "header"): 2}
    files = {os.path.basename(r["file"]): (r["lines"], r["header_ok"]) for r in found.files.collect()}
    assert files == {"good.csv": (6, True), "other.csv": (3, False), "late.csv": (3, False), "only.csv": (1, True)}


def test_header_of_a_file_read_by_many_tasks(spark, tmpdir_path):
    folder = put(f"{tmpdir_path}/big", one=f"{HEADER}\n" + f"{LINE}\n" * 5000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        found = load_sessions_csv(spark, folder)
        assert found.rows.rdd.getNumPartitions() > 1
        assert found.rows.count() == 5000 and found.quarantine.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("rows", [0, 4])
def test_written_lines_begin_with_the_header(spark, tmpdir_path, rows):
    df = spark.createDataFrame([(LINE,)] * rows, "line string").coalesce(1)
    write_lines(df, f"{tmpdir_path}/out")
    (part,) = [f for f in os.listdir(f"{tmpdir_path}/out") if f.startswith("part-")]
    assert open(f"{tmpdir_path}/out/{part}").read().splitlines() == [HEADER] + [LINE] * rows
