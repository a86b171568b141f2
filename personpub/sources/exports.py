"""Export files: quoted fields, backslash escapes, `\\N` for null, no header."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.schemas import LAYOUTS, export_schema

# A file with line ends inside fields is read by one task, so files are kept small.
FILE_ROWS = 500_000
STAMPED = r"(\d{8}_\d{6})_persons"


def _dialect(repaired: bool) -> dict[str, str]:
    return {
        "sep": ",",
        "quote": '"',
        "escape": '"' if repaired else "\\",
        "nullValue": "\\N",
        "emptyValue": "",
        "multiLine": "true",
        "encoding": "UTF-8",
        "mode": "PERMISSIVE",
    }


def read_export(
    spark: SparkSession, path: str, layout: str = "v2", repaired: bool = False
) -> DataFrame:
    """Rows of an export by column name.

    `repaired` files have quotes doubled instead of escaped.
    """
    return spark.read.schema(export_schema(layout)).options(**_dialect(repaired)).csv(path)


def export_lines(rows: DataFrame, layout: str = "v2") -> DataFrame:
    """One text line per row."""

    def field(name: str) -> Column:
        text = F.replace(F.col(name).cast("string"), F.lit("\\"), F.lit("\\\\"))
        text = F.replace(text, F.lit('"'), F.lit('\\"'))
        return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("\\N"))

    return rows.select(F.concat_ws(",", *[field(c) for c in LAYOUTS[layout]]).alias("value"))


def write_export(rows: DataFrame, folder: str, now: datetime, layout: str = "v2") -> str:
    """Write the rows to a new time-stamped directory below `folder`."""
    path = f"{folder}/{now:%Y%m%d_%H%M%S}_persons"  # as in STAMPED
    export_lines(rows, layout).write.option("maxRecordsPerFile", FILE_ROWS).text(path)
    return path


def change_stream(
    spark: SparkSession, path: str, layout: str = "v2", files_per_batch: int = 100
) -> DataFrame:
    """New export files as they come; `path` may be a pattern over export directories.

    `stamp` is the time in the directory's name, which orders the exports.
    """
    rows = (
        spark.readStream.schema(export_schema(layout))
        .options(**_dialect(False))
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )
    stamp = F.regexp_extract(F.col("_metadata.file_path"), STAMPED, 1)
    return rows.withColumn("stamp", stamp)
