"""Landing files in JSON lines or CSV, with unreadable records set aside.

Text landings are read against the declared schema of their Parquet form, in one
parse.  A line that does not fit the schema (cut short, a word where a number
belongs, too few or too many fields) goes whole to the rejects, so that good rows
are never mixed with half-read ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelyard.functions.joins import store_table

REJECT = "_rejected"

# CSV without a header: quotes are doubled, an empty field is an empty text and \N
# is null.  Written with ``CSV_OUT``, read with ``CSV``.
CSV = {"quote": '"', "escape": '"', "header": "false", "emptyValue": "", "nullValue": "\\N"}
CSV_OUT = CSV | {"emptyValue": '""'}


def read_text_landing(spark: SparkSession, path: str, schema: StructType, kind: str) -> DataFrame:
    """All lines of the files below ``path``, typed, with ``_rejected`` (the text
    of a line that does not fit).  Lines are records, so files are split."""
    declared = StructType([*schema.fields, StructField(REJECT, StringType(), True)])
    reader = (spark.read.schema(declared).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", REJECT))
    if kind == "json":
        return reader.json(path)
    if kind == "csv":
        return reader.options(**CSV).csv(path)
    raise ValueError(f"kind is json or csv, not {kind!r}")


def land_text(spark: SparkSession, path: str, schema: StructType, kind: str) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: typed rows, and the rejected lines with their file.

    The files are parsed once, into a table in the shared scratch folder that
    both results read.
    """
    lines = read_text_landing(spark, path, schema, kind)
    stored = store_table(lines.select("*", F.col("_metadata.file_path").alias("_file")), f"landed-{kind}")
    bad = F.col(REJECT).isNotNull()
    good = stored.where(~bad).select(*schema.fieldNames())
    return good, stored.where(bad).select(F.col("_file").alias("file"), F.col(REJECT).alias("line"))
