"""Text scans and sinks: position messages and vessel metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.functions.ids import missing_number_to_null
from wakeline.schema import AIS, GROUPED_METADATA, MEAN_COLUMNS, METADATA

BAD_RECORD = "bad_record"
# Fractions of a second may be there or not.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_ais_csv(
    spark: SparkSession,
    paths: str | list[str],
    timestamp_format: str = TIMESTAMP_FORMAT,
    schema: T.StructType = AIS,
    keep_bad_records: bool = False,
) -> DataFrame:
    """Scan of a file glob with a fixed schema: header line skipped, nothing inferred.
    Lines that do not fit keep their readable columns; with ``keep_bad_records`` the
    whole line is in ``bad_record``."""
    if keep_bad_records:
        schema = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("timestampNTZFormat", timestamp_format)
        # Names bind by position, as the monthly files spell their headers differently.
        .option("enforceSchema", True)
    )
    if keep_bad_records:
        reader = reader.option("columnNameOfCorruptRecord", BAD_RECORD)
    return reader.csv(paths)


def write_ais_csv(ais: DataFrame, path: str, timestamp_format: str = TIMESTAMP_FORMAT) -> None:
    ais.write.option("header", True).option("timestampNTZFormat", timestamp_format).csv(path)


def write_metadata_csv(meta: DataFrame, path: str) -> None:
    """Sorted metadata as CSV part files with a header; missing values are empty and names
    with a comma are quoted. Written by the tasks, nothing is collected."""
    meta.write.option("header", True).option("nullValue", "").option("emptyValue", '""').csv(path)


def _typed(text: Column, kind: T.DataType) -> Column:
    """Text as ``kind``, NULL where it does not fit; ``36.0`` is a whole number."""
    if isinstance(kind, T.IntegerType):
        number = text.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    return text.try_cast(kind)


def read_metadata_csv(spark: SparkSession, path: str, rename: dict[str, str] | None = None) -> DataFrame:
    """Metadata bound by header name, whatever the column order in the file; ``rename``
    maps header names to ours."""
    text = spark.read.option("header", True).csv(path)
    types = {f.name: f.dataType for f in (*METADATA.fields, *GROUPED_METADATA.fields)}
    rename = rename or {}
    columns = []
    for header in text.columns:
        name = rename.get(header, header)
        column = _typed(F.col(f"`{header}`"), types.get(name, T.StringType()))
        columns.append((missing_number_to_null(column) if name in MEAN_COLUMNS else column).alias(name))
    return text.select(*columns)
