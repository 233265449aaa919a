"""Sources: JSON lines, CSV, parquet streams, and the rescue of odd JSON fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.streaming.run import RunReport, run_available

RESCUED = "_rescued_data"


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """All columns, the time of the run and the name of the source file."""
    return df.select(
        "*", F.current_timestamp().alias("processing_time"), F.col("_metadata.file_name").alias("source_file")
    )


def _lost(raw: Column, typed: Column, kind: T.DataType) -> Column:
    """Whether a present raw JSON value did not (wholly) make it into its field."""
    lost = typed.isNull()
    if not isinstance(kind, T.StructType):
        return lost
    names = F.array(*[F.lit(inner.name) for inner in kind])
    lost = lost | F.coalesce(F.size(F.array_except(F.json_object_keys(raw), names)) > 0, F.lit(False))
    for inner in kind:
        value = F.get_json_object(raw, f"$['{inner.name}']")
        lost = lost | (value.isNotNull() & _lost(value, typed[inner.name], inner.dataType))
    return lost


def _may_be_odd(raw: Column, typed: Column, fields: list[T.StructField]) -> Column:
    """False only if every key of the raw object has its value in a typed field."""
    filled = reduce(lambda a, b: a + b, [F.when(typed[field.name].isNotNull(), 1).otherwise(0) for field in fields])
    odd = F.coalesce(F.size(F.json_object_keys(raw)) != filled, F.lit(True))
    for field in fields:
        if isinstance(field.dataType, T.StructType):
            inner = F.get_json_object(raw, f"$['{field.name}']")
            value = typed[field.name]
            odd = odd | (value.isNotNull() & _may_be_odd(inner, value, field.dataType.fields))
    return odd


def parse_json_rescued(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Parse JSON text to ``schema``; what does not fit goes to ``_rescued_data``.

    The rescue column holds, as JSON, fields outside the schema and fields whose
    value does not have the declared type; a line that is no JSON goes there
    whole. It is null when nothing was left over. Most lines fit: there the
    number of keys equals the number of typed values, and the line is not taken
    apart any further.
    """
    text, typed = F.col(column), F.col("_typed")

    def left_over(name: Column, raw: Column) -> Column:
        odd = F.when(raw.isNull(), False)
        for field in schema:
            odd = odd.when(name == field.name, _lost(raw, typed[field.name], field.dataType))
        return odd.otherwise(True)

    rescued = F.when(F.col("_odd") & F.col("_raw").isNull(), F.nullif(F.trim(text), F.lit(""))).when(
        F.size("_left") > 0, F.to_json("_left")
    )
    others = [name for name in df.columns if name != column]
    return (
        df.withColumn("_typed", F.from_json(text, schema))
        .withColumn("_odd", _may_be_odd(text, typed, schema.fields))
        .withColumn("_raw", F.when(F.col("_odd"), F.from_json(text, "map<string,string>")))
        .withColumn("_left", F.when(F.col("_odd"), F.map_filter("_raw", left_over)))
        .select(*[typed[field.name].alias(field.name) for field in schema], *others, rescued.alias(RESCUED))
    )


def stream_json(
    spark: SparkSession, src: str, schema: T.StructType, rescue: bool = False, max_files: int | None = None
) -> DataFrame:
    """New JSON-lines files below ``src`` as a stream, with ingest metadata."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if not rescue:
        return with_ingest_metadata(reader.schema(schema).json(src))
    # Blank lines are no records, as in Spark's own JSON reader.
    lines = with_ingest_metadata(reader.text(src)).filter(F.trim("value") != "")
    parsed = parse_json_rescued(lines, "value", schema)
    names = [field.name for field in schema]
    return parsed.select(*names, RESCUED, "processing_time", "source_file")


def ingest_json(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    dst: str,
    checkpoint: str,
    rescue: bool = False,
    max_files: int | None = None,
) -> RunReport:
    """Append the files not read before to the parquet table ``dst``, then stop."""
    return run_available(stream_json(spark, src, schema, rescue, max_files), dst, checkpoint)


def read_stream_table(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """An append-only parquet table as a stream, in batches of ``max_files`` if given."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, rescue: bool = False) -> DataFrame:
    """CSV files whose headers must be the schema's names in its order; others are an error.

    With ``rescue`` a last column keeps the lines that hold a value of the wrong type.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if not rescue:
        return reader.schema(schema).csv(path)
    fields = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    return reader.option("columnNameOfCorruptRecord", RESCUED).schema(fields).csv(path)
