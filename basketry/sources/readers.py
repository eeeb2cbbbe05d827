"""Readers for the interaction formats: JSON lines, CSV with header, Parquet.

Every reader takes an explicit schema (no inference pass over the data) so
that Catalyst can prune columns and push filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields of a review line that the activity report and the city ranking read.
REVIEW_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("date", T.TimestampType()),
])

#: Fields of a business line used by the city ranking.
BUSINESS_SCHEMA = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
])

#: Two-column interaction file (extra columns are ignored by name).
INTERACTION_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType,
                    mode: str = "FAILFAST", required: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object per line.

    ``FAILFAST`` (default) raises on a malformed line, like a parser that
    insists on every id; ``PERMISSIVE`` keeps such lines with nulls and the
    raw text in ``_corrupt_record``.  With ``FAILFAST`` a line without one of
    the ``required`` fields fails as well, when it is read.
    """
    reader = spark.read.option("mode", mode)
    if mode.upper() == "PERMISSIVE":
        schema = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
    rows = reader.schema(schema).json(path)
    return demand(rows, required) if mode.upper() == "FAILFAST" else rows


def demand(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``rows``, failing on the first row that is read with a null in one of ``columns``."""
    checked = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"a row has no {c}")).cast(rows.schema[c].dataType)) for c in columns}
    return rows.withColumns(checked) if checked else rows


def read_reviews(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_json_lines(spark, path, REVIEW_SCHEMA, mode, ("user_id", "business_id"))


def read_businesses(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_json_lines(spark, path, BUSINESS_SCHEMA, mode, ("business_id",))


def read_interactions_csv(spark: SparkSession, path: str,
                          schema: T.StructType = INTERACTION_SCHEMA, header: list[str] | None = None) -> DataFrame:
    """CSV with a header line; the schema's columns are taken by name, extras ignored.

    ``header`` names the file's columns in order where it has others than the
    schema's; without it they are the schema's own.  The reader gets the full
    schema and checks the header against it, so no job looks at the file
    first.  A row without an id fails when it is read.
    """
    kinds = {f.name: f.dataType for f in schema.fields}
    full = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header or schema.fieldNames()])
    rows = spark.read.schema(full).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return demand(rows.select(*schema.fieldNames()), tuple(schema.fieldNames()))


def parse_json_column(df: DataFrame, column: str, schema: T.StructType | str,
                      alias: str = "parsed") -> DataFrame:
    """Parse a JSON text column into a struct (``from_json``)."""
    return df.withColumn(alias, F.from_json(F.col(column), schema))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
