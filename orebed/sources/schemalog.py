"""JSON lines without a declared schema: an inferred schema that is kept in versions.

A table is a folder with its schemas (``schema/v1.json``, ...), its rows by
schema version and batch (``data/v1/b0``, ...), one entry per finished batch
(``commits``) and the checkpoint of the stream. A batch is written with the
newest schema; only if some line does not fit, those lines are read again to
see what they hold. New fields are added and types are widened in a new version,
and the batch is written again with it. A feed that keeps its form is thus read
once, and rows written before are never rewritten: readers bring them to the
version they want.

Types widen from whole numbers to doubles and from anything else that differs
to text; objects widen field by field, arrays by their elements. A field stays
out of the schema while it held only nulls, empty objects or empty arrays. What
has no place goes to ``_rescued_data``: lines that are no JSON object, empty
objects, names that differ from a field's in letter case only or that the table
needs itself. Whole numbers beyond 64 bits, or beyond 2^53 in a field of
doubles, keep a double's precision.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed import paths
from orebed.sources.files import RESCUED, parse_json_rescued, with_ingest_metadata
from orebed.streaming.run import RunReport, run_batches

OWN = T.StructType(
    [
        T.StructField("processing_time", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField(RESCUED, T.StringType()),
    ]
)
_LINE = "_line"
_TAKEN = {*(name.lower() for name in OWN.names), _LINE}


# Types


def _plain(kind: T.DataType) -> T.DataType | None:
    """A seen type as one the table stores; None where no value was seen."""
    if isinstance(kind, T.StructType):
        return widen(T.StructType(), kind) or None
    if isinstance(kind, T.ArrayType):
        element = _plain(kind.elementType)
        return element and T.ArrayType(element)
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    return kind if isinstance(kind, (T.LongType, T.DoubleType, T.BooleanType)) else T.StringType()


def _wider(old: T.DataType, new: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if old == new:
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return widen(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_wider(old.elementType, new.elementType))
    numbers = (T.LongType, T.DoubleType)
    return T.DoubleType() if isinstance(old, numbers) and isinstance(new, numbers) else T.StringType()


def widen(old: T.StructType, seen: T.StructType, taken: frozenset[str] | set[str] = frozenset()) -> T.StructType:
    """``old`` with its types widened and the new fields of ``seen`` added at the end."""
    kinds = {field.name: field.dataType for field in old}
    used = {name.lower() for name in kinds} | taken
    for field in seen:
        kind = _plain(field.dataType)
        if kind is None:
            continue
        if field.name in kinds:
            kinds[field.name] = _wider(kinds[field.name], kind)
        elif field.name.lower() not in used:
            kinds[field.name] = kind
            used.add(field.name.lower())
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def seen_schema(lines: DataFrame, column: str = "value") -> T.StructType:
    """The fields of all JSON objects among the lines, by one aggregate. Other lines are passed over."""
    text = F.col(column)
    objects = lines.filter(F.ltrim(text).startswith("{")).select(F.try_parse_json(text).alias("v"))
    found = objects.agg(F.schema_of_variant_agg("v")).first()[0] or ""
    # The names are quoted where needed; a type name stands outside of quotes.
    ddl = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda part: part[1] or "STRUCT<", found)
    return T.DataType.fromDDL(ddl) if ddl.startswith("STRUCT<") else T.StructType()


# The log of schemas and batches


def _numbers(spark: SparkSession, folder: str, pattern: str) -> list[tuple[int, ...]]:
    found = (re.fullmatch(pattern, name) for name in paths.list_names(spark, folder))
    return sorted(tuple(map(int, part.groups())) for part in found if part)


def schema_versions(spark: SparkSession, root: str) -> dict[int, T.StructType]:
    """All versions of the schema, oldest first."""
    numbers = [number for number, in _numbers(spark, f"{root}/schema", r"v(\d+)\.json")]
    texts = {number: paths.read_text(spark, f"{root}/schema/v{number}.json") for number in numbers}
    return {number: T.StructType.fromJson(json.loads(text)) for number, text in texts.items()}


def batches(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """Each finished batch with the schema version it was written in."""
    return _numbers(spark, f"{root}/commits", r"b(\d+)-v(\d+)\.json")


def _folder(root: str, version: int, batch: int) -> str:
    return f"{root}/data/v{version}/b{batch}"


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    if schema.fields:
        return parse_json_rescued(lines, "value", schema)
    others = [name for name in lines.columns if name != "value"]
    return lines.select(*others, F.trim("value").alias(RESCUED))


def _take(root: str, lines: DataFrame, batch: int) -> None:
    """Write one batch, in a new schema version if its lines need one. A batch that is done is left alone."""
    spark = lines.sparkSession
    if any(done == batch for done, _ in batches(spark, root)):
        return
    known = schema_versions(spark, root)
    version, schema = max(known.items(), default=(0, T.StructType()))
    while True:
        rows = rescued = 0
        if version:
            folder = _folder(root, version, batch)
            _parsed(lines, schema).write.mode("overwrite").parquet(folder)
            written = spark.read.schema(_stored(schema)).parquet(folder)
            rows, rescued = written.agg(F.count(F.lit(1)), F.count(RESCUED)).first()
            if not rescued:
                break
            odd = _parsed(lines.withColumn(_LINE, F.col("value")), schema).filter(F.col(RESCUED).isNotNull())
            wider = widen(schema, seen_schema(odd, _LINE), _TAKEN)
            if wider == schema:
                break
            paths.remove(spark, folder)
        else:
            wider = widen(schema, seen_schema(lines), _TAKEN)
        version, schema = version + 1, wider
        if not paths.write_new(spark, f"{root}/schema/v{version}.json", schema.json()):
            raise RuntimeError(f"{root}: another writer has added schema version {version}")
    counts = json.dumps({"rows": rows, "rescued": rescued})
    paths.write_text(spark, f"{root}/commits/b{batch}-v{version}.json", counts)


def ingest_inferred(spark: SparkSession, src: str, root: str, max_files: int | None = None) -> RunReport:
    """Add the files below ``src`` not read before to the table ``root``, then stop."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = with_ingest_metadata(reader.text(src)).filter(F.trim("value") != "")
    for folder in ("schema", "commits"):
        paths.make_dirs(spark, f"{root}/{folder}")
    before = set(batches(spark, root))
    run_batches(lines, lambda frame, batch: _take(root, frame, batch), f"{root}/checkpoint")
    added = [entry for entry in batches(spark, root) if entry not in before]
    texts = [paths.read_text(spark, f"{root}/commits/b{batch}-v{version}.json") for batch, version in added]
    return RunReport(rows_read=sum(json.loads(text)["rows"] for text in texts), batches=len(added))


# Readers


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *OWN.fields])


def _brought(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one version's type in another's; null where it has no such value."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {field.name: field.dataType for field in have}
        parts = [
            (_brought(value[field.name], kinds[field.name], field.dataType) if field.name in kinds
             else F.lit(None).cast(field.dataType)).alias(field.name)
            for field in want
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda part: _brought(part, have.elementType, want.elementType))
    nested = (T.StructType, T.ArrayType)
    if isinstance(have, nested):
        return F.to_json(value) if isinstance(want, T.StringType) else F.lit(None).cast(want)
    if isinstance(want, nested):
        return F.from_json(value, want) if isinstance(have, T.StringType) else F.lit(None).cast(want)
    return value.try_cast(want)


def _as_text(value: Column, kind: T.DataType) -> Column:
    return F.to_json(value) if isinstance(kind, (T.StructType, T.ArrayType)) else value.cast("string")


def _in_version(df: DataFrame, have: T.StructType, want: T.StructType) -> DataFrame:
    """Rows stored in one version as rows of another; what has no place there is rescued."""
    kinds = {field.name: field.dataType for field in want}

    def column(name: str) -> Column:
        return F.col("`" + name.replace("`", "``") + "`")

    values, left = {}, []
    for field in have:
        value, text = column(field.name), _as_text(column(field.name), field.dataType)
        if field.name not in kinds:
            left.append((field.name, value.isNotNull(), text))
            continue
        kind = kinds[field.name]
        brought = _brought(value, field.dataType, kind)
        if _wider(field.dataType, kind) != kind:
            back = _as_text(_brought(brought, kind, field.dataType), field.dataType)
            lost = value.isNotNull() & ~text.eqNullSafe(back)
            left.append((field.name, lost, text))
            brought = F.when(~lost, brought)
        values[field.name] = brought
    rescued = F.col(RESCUED)
    if left:
        pairs = [F.when(lost, F.struct(F.lit(name).alias("key"), text.alias("value"))) for name, lost, text in left]
        over = F.map_from_entries(F.filter(F.array(*pairs), lambda pair: pair.isNotNull()))
        before = F.coalesce(F.from_json(rescued, "map<string,string>"), F.expr("cast(map() as map<string,string>)"))
        rescued = F.when(F.size(over) > 0, F.to_json(F.map_concat(before, over))).otherwise(rescued)
    return df.select(
        *[values.get(field.name, F.lit(None).cast(field.dataType)).alias(field.name) for field in want],
        "processing_time",
        "source_file",
        rescued.alias(RESCUED),
    )


def read_inferred(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """All finished batches in the newest schema, or in that of a version; None before the first.

    A reader that stays with an older version still sees every row: columns added later,
    and values that the older type cannot hold, come in ``_rescued_data``.
    """
    known = schema_versions(spark, root)
    if not known:
        return None
    want = known[max(known) if version is None else version]
    folders: dict[int, list[str]] = {}
    for batch, number in batches(spark, root):
        folders.setdefault(number, []).append(_folder(root, number, batch))
    result = spark.createDataFrame([], _stored(want))
    for number, names in folders.items():
        stored = spark.read.schema(_stored(known[number])).parquet(*names)
        result = result.unionByName(_in_version(stored, known[number], want))
    return result
