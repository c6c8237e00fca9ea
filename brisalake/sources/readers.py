"""Scans of landed files."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """CSV with header. Give the schema for large files: inference reads them twice."""
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


CORRUPT, BAD = "_corrupt_record", ("_file", "_record", "_reason")


def scan_csv_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of CSV under a declared schema.

    A row is quarantined if it has another number of fields than the schema, a field
    that does not read as its type, or no value in a field that must have one. Its
    file, its text and the first reason are kept: ``campos:<n>`` for the
    number of fields, ``tipo:<column>``, ``nulo:<column>``. Every other row is good, so
    the two together are all rows. Both are lazy and read the files once each. A quote
    within quotes is doubled, as most tools write it.
    """
    options = {"sep": sep, "mode": "PERMISSIVE", "escape": '"'}
    optional = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    read = optional.add(T.StructField(CORRUPT, T.StringType(), True))
    rows = (spark.read.schema(T.StructType(read.fields)).option("header", header).options(**options)
            .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", True).csv(path)
            .withColumn("_file", F.col("_metadata.file_path")))
    fields = F.from_csv(F.col(CORRUPT), text.simpleString()[7:-1].replace(":", " "), options)
    # The number of fields: separators outside quotes, and one.
    bare = F.regexp_replace(CORRUPT, '"[^"]*"', "")
    n = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    wrong = [F.when(F.col(f"_text.{f.name}").isNotNull() & F.col(f.name).isNull(), F.lit(f"tipo:{f.name}")) for f in schema.fields]
    empty = [F.when(F.col(f.name).isNull(), F.lit(f"nulo:{f.name}")) for f in schema.fields if not f.nullable]
    broken = F.when(n != len(schema.fields), F.concat(F.lit("campos:"), n.cast("string")))
    reason = F.when(F.col(CORRUPT).isNotNull(), F.coalesce(broken, *wrong, F.lit("ilegivel")))
    reason = F.coalesce(reason, *empty) if empty else reason
    judged = rows.withColumn("_text", fields).withColumn("_reason", reason)
    whole = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*schema.names), {"sep": sep}))
    return (judged.filter("_reason IS NULL").select(*schema.names),
            judged.filter("_reason IS NOT NULL").select("_file", whole.alias("_record"), "_reason"))


def quarantine(bad: DataFrame, path: str, run_id: str) -> DataFrame:
    """Append quarantined rows under their run, replacing what the same run left before; the table so far."""
    (bad.withColumn("_run", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_run").parquet(path))
    return bad.sparkSession.read.parquet(path)


def first_readable(sources: Sequence[tuple[str, Callable[[], DataFrame]]]) -> DataFrame:
    """Rows of the first source that is there, with its name as ``_source``; an error that names each one's if none is.

    A source that is missing or unreadable when its plan is made gives way to the next;
    what fails later, while rows are read, is an error of its own.
    """
    failed = []
    for name, read in sources:
        try:
            return read().withColumn("_source", F.lit(name))
        except AnalysisException as error:
            failed.append(f"{name}: {str(error).splitlines()[0]}")
    raise FileNotFoundError("no source is readable: " + "; ".join(failed))


def scan_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


#: Types that a merged schema names, and how they are read: a conflict or an object without fields is text, a decimal a double.
_READ_AS = {"OBJECT": "STRUCT", "OBJECT<>": "STRING", "VARIANT": "STRING", "VOID": "STRING", "DECIMAL": "DOUBLE"}


def json_schema(df: DataFrame, col: str) -> T.StructType:
    """The schema that holds every document of a text column: the union of their fields, at every depth.

    Each task merges the schemas of its documents and only merged schemas are
    shuffled. Fields of several types become the wider type, or text if there is none;
    fields that are always null are text; documents that are not JSON objects do not
    count; no documents give no fields.
    """
    parsed = F.try_parse_json(F.col(col))
    objects = F.when(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), parsed)
    merged = df.agg(F.schema_of_variant_agg(objects).alias("s")).first()["s"]
    if not merged or not merged.startswith("OBJECT"):
        return T.StructType([])
    # Quoted names stay; a plain name that is spelled like a type is followed by a colon.
    types = r"`(?:[^`]|``)*`|\bOBJECT<>|\b(?:OBJECT|VARIANT|VOID|DECIMAL\(\d+,\d+\))(?!:)"
    ddl = re.sub(types, lambda m: _READ_AS.get(m[0].split("(")[0], m[0]), merged)
    return T._parse_datatype_string(ddl)


def flatten_json(df: DataFrame, col: str | None = None, schema: T.StructType | str | None = None,
                 sep: str = "_") -> DataFrame:
    """Nested objects as flat columns; ``.`` and ``-`` in names become ``sep``.

    With ``col`` the JSON text of that column is parsed first (malformed text
    gives nulls) and its fields are prefixed by the column name. Without a schema the
    text's own is found first, in a pass over all rows (``json_schema``).
    """
    if col is not None:
        schema = json_schema(df, col) if schema is None else schema
        df = df.withColumn(col, F.from_json(col, schema))

    def leaves(fields, path):
        for f in fields:
            full = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType.fields, full)
            else:
                yield full

    def clean(path):
        return sep.join(path).replace(".", sep).replace("-", sep)

    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(clean(path))
                       for path in leaves(df.schema.fields, [])])


def optional_columns(df: DataFrame, defaults: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add each absent column as (type, value); present columns are left alone."""
    absent = {c: F.lit(v).cast(kind) for c, (kind, v) in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def pruned_extract(df: DataFrame, columns: Sequence[str], year_col: str, years: Sequence[int]) -> DataFrame:
    """Named columns of named years.

    A date column is filtered by ranges of dates, not by ``year(col)``: ranges
    are pushed into the parquet scan, a function call is not.
    """
    kind = df.schema[year_col].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        name = kind.simpleString()
        keep = F.lit(False)
        for y in years:
            start, end = (F.lit(f"{x}-01-01").cast(name) for x in (y, y + 1))
            keep = keep | ((F.col(year_col) >= start) & (F.col(year_col) < end))
    else:
        keep = F.col(year_col).isin(*years)
    return df.filter(keep).select(*columns)
