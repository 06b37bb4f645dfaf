"""Typed tables from landed JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, VariantType

from reelyard.functions.columns import empty_array
from reelyard.schemas import page_schema


# Filled by the parser with the text of a body (or record) it could not read.
CORRUPT = "_corrupt_record"


def _parse_schema(schema: StructType, as_variant: tuple = ()) -> StructType:
    """``schema`` with the ``as_variant`` fields read as VARIANT, which keeps a
    missing key (SQL NULL) apart from an explicit JSON null (variant null)."""
    return StructType([StructField(f.name, VariantType(), True) if f.name in as_variant else f
                       for f in schema.fields])


def _parsed(body: str, schema: StructType) -> Column:
    """The one parse of a JSON text.  It is projected on its own and its fields
    are read in the next projection, so the optimizer keeps a single parse."""
    fields = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    return F.from_json(F.col(body), fields, {"columnNameOfCorruptRecord": CORRUPT})


def _numeral(value: Column) -> Column:
    """A VARIANT as the text that a typed string read gives: ``0``, ``6.0``, ``7.5``."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double").cast("string")
    return F.when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), number).otherwise(text)


def _from_variant(value: Column, field: StructField) -> Column:
    if isinstance(field.dataType, StringType):
        return _numeral(value)
    return F.try_variant_get(value, "$", field.dataType.simpleString())


def _typed_field(value: Column, field: StructField, missing_empty: tuple) -> Column:
    if field.name not in missing_empty:
        return value
    return (F.when(value.isNull(), empty_array(field.dataType.elementType))
            .otherwise(_from_variant(value, field)))


def _retype(rec: Column, schema: StructType, missing_empty: tuple) -> Column:
    return F.struct(*[_typed_field(rec[f.name], f, missing_empty).alias(f.name)
                      for f in schema.fields])


def typed_records(df: DataFrame, body: str, schema: StructType,
                  keep: tuple[str, ...] = (), missing_empty: tuple = (),
                  missing_default: dict | None = None,
                  readable: str | None = None) -> DataFrame:
    """Parse the JSON text in ``body`` against a declared schema.

    Fields outside the schema are dropped, missing keys become null, and a JSON
    number read into a string field becomes its numeral text (``7.25`` ->
    ``'7.25'``, ``6.0`` -> ``'6.0'``, ``7.50`` -> ``'7.5'``).  Array fields
    named in ``missing_empty`` become ``[]`` when the key is missing but stay
    null for an explicit JSON null; fields in ``missing_default`` take the given
    value when the key is missing, again keeping an explicit null (such fields
    are read as VARIANT in the same parse).  ``keep`` columns of the input ride
    along in front; ``readable`` names a last column that tells whether the
    body could be read at all.
    """
    missing_default = missing_default or {}
    as_variant = (*missing_empty, *missing_default)
    # A partition number keeps a filter on ``readable`` above the parse: pushed below
    # it, the filter would parse every body again.
    row = F.spark_partition_id() if readable else F.lit(0)
    out = df.select(*keep, F.col(body).isNotNull().alias("_there"), row.alias("_row"),
                    _parsed(body, _parse_schema(schema, as_variant)).alias("_rec"))
    fields = []
    for f in schema.fields:
        value = F.col("_rec")[f.name]
        if f.name in missing_default:
            value = (F.when(value.isNull(), F.lit(missing_default[f.name]).cast(f.dataType))
                     .otherwise(_from_variant(value, f)))
        else:
            value = _typed_field(value, f, missing_empty)
        fields.append(value.alias(f.name))
    if readable:
        there = F.col("_there") & (F.col("_row") >= 0)
        fields.append((there & F.col("_rec")[CORRUPT].isNull()).alias(readable))
    return out.select(*keep, *fields)


def typed_pages(landed: DataFrame, record: StructType, missing_empty: tuple = ()) -> DataFrame:
    """Landed pages ``(day, page, status, body)`` -> typed envelope columns.

    Output: ``day, page, status, total_pages, results, readable`` with
    ``results`` an array of ``record`` (``missing_empty`` as in
    ``typed_records``).  Error bodies parse to null envelope fields; a body
    that is no JSON at all (cut short, say) is not ``readable``.
    """
    env = page_schema(_parse_schema(record, missing_empty))
    results = F.col("_env.results")
    if missing_empty:
        results = F.transform(results, lambda r: _retype(r, record, missing_empty))
    broken = (F.col("body").isNull()
              | (F.col(f"_env.{CORRUPT}").isNotNull() & F.col("_env.total_pages").isNull()
                 & F.col("_env.results").isNull()))
    return (landed
            .select("day", "page", "status", "body", _parsed("body", env).alias("_env"))
            .select("day", "page", "status",
                    F.col("_env.total_pages").alias("total_pages"),
                    results.alias("results"), (~broken).alias("readable")))


def typed_records_empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A zero-row table with the full declared schema (no records landed)."""
    return spark.createDataFrame([], schema)
