"""Readers and writers: parquet tables, CSV in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .csv_records import read_csv_table


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet); filters and projections push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, malformed: str = "fail") -> DataFrame:
    """CSV with a header, UTF-8, RFC-4180 quoting (doubled quotes and line
    breaks inside quoted fields), CRLF or LF line ends (S1).

    Every column is read as text: type coercion is the cleaning step's job,
    so bad values become NULL there instead of failing the read. Records with
    too few or too many fields, or whose quotes never close, raise an error;
    ``malformed="drop"`` leaves them out, and
    :func:`~ledgerline.sources.csv_records.read_csv_table` returns them."""
    if malformed not in ("fail", "drop"):
        raise ValueError("malformed must be 'fail' or 'drop'")
    table = read_csv_table(spark, path, columns)
    bad = table.rejected.limit(1).collect() if malformed == "fail" else []
    if bad:
        raise ValueError(f"{bad[0]['source_file']}, byte block {bad[0]['source_block']}, line {bad[0]['source_line']}: {bad[0]['reason']}")
    return table.rows


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Overwrite a folder of CSV part files with a header row (S3). White
    space at the ends of values is kept. Files compressed by ``gzip`` take a
    fraction of the disk, but each is then read by one task."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').option("dateFormat", "yyyy-MM-dd")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("compression", compression).csv(path))
