"""Session CSV files with a check per file and per line (A1).

Every file must begin with the contract's 18 column names in order.  Lines of a file that does not go to the quarantine as
``header``; lines of a good file with too few or too many fields, or with broken quoting, go there as ``malformed``.  What is left are
rows of text columns, which the session contract types and judges.

Lines are read once as text and parsed by one expression, so a line is a record (session values have no line breaks)
and a file of any size is split among tasks.  The per-file table has one row per file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.joins import join_on
from cartwheel.schema import EXPECTED_COLUMNS

HEADER = ",".join(EXPECTED_COLUMNS)
_SCHEMA = ", ".join(f"{c} STRING" for c in (*EXPECTED_COLUMNS, "__broken"))


@dataclass
class CsvSessions:
    """``rows``: 18 text columns; ``quarantine``: (file, line, reason); ``files``: (file, lines, header_ok)."""

    rows: DataFrame
    quarantine: DataFrame
    files: DataFrame


def load_sessions_csv(spark: SparkSession, path: str) -> CsvSessions:
    """A1: all CSV files under ``path``; blank lines are no records."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "_metadata.file_block_start",
                                         F.monotonically_increasing_id().alias("place"), F.regexp_replace("value", "\r$", "").alias("line"))
    lines = lines.where(F.trim("line") != "")
    # the least place of a file's first block is its first line: places ascend within a task, blocks by their start
    first = F.min(F.struct("file_block_start", "place", "line"))["line"]
    files = lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), (first == HEADER).alias("header_ok"))
    data = join_on(lines.where(F.col("line") != HEADER), files.select("file", "header_ok"), "file", "inner")
    parsed = F.from_csv("line", _SCHEMA, {"columnNameOfCorruptRecord": "__broken", "mode": "PERMISSIVE"})
    data = data.select("file", "line", "header_ok", parsed.alias("r"))
    good = F.col("header_ok") & F.col("r.__broken").isNull()
    reason = F.when(~F.col("header_ok"), "header").otherwise("malformed")
    return CsvSessions(data.where(good).select(*[F.col(f"r.{c}").alias(c) for c in EXPECTED_COLUMNS]),
                       data.where(~good).select("file", "line", reason.alias("reason")), files)


def session_lines(sessions: DataFrame) -> DataFrame:
    """Sessions as CSV lines (keys, line), with broken lines by slot = (user_id * 31 + day) % 40.

    Fixed faults: 0 the last field cut off, 1 one field too many, 2 a lone quote before the first field.
    """
    slot = (F.col("user_id") * 31 + F.dayofmonth("session_date")) % 40
    line = F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in EXPECTED_COLUMNS]))
    return sessions.select("user_id", "session_date", F.when(slot == 0, F.regexp_replace(line, ",[^,]*$", "")).when(slot == 1, F.concat(line, F.lit(",1")))
                           .when(slot == 2, F.concat(F.lit('"'), line)).otherwise(line).alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Write CSV lines as files that each begin with the header: one column named like it, without quoting."""
    (lines.select(F.col("line").alias(HEADER)).write.option("header", True).option("sep", "\x01").option("quote", "")
     .option("escape", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
