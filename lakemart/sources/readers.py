"""Raw file readers (I1-I8).  Files are read in place, in parallel, with a declared schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.casts import null_if
from lakemart.functions.dates import now
from lakemart.sources import arrays, schemas

# Texts that stand for NULL in delimited files.
NULL_TOKENS = ("", "NULL")

#: One bad record fails the load.  Columns go by position; the header line is only skipped.
CSV_OPTIONS = {"header": "true", "enforceSchema": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}


def blank_to_null(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """I4: tokens to NULL in every string column; the reader itself knows only one token."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: null_if(F.col(c), *tokens) for c in strings})


def with_lineage(df: DataFrame, run_id: str, loaded_at: dt.datetime | None = None) -> DataFrame:
    """Load time, file and run of each row; call it right after the read, while files are known."""
    at = F.lit(loaded_at.isoformat(" ")) if loaded_at else now()
    return df.select(
        "*",
        at.cast("timestamp_ntz").alias("_loaded_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(run_id).alias("_run_id"),
    )


def read_delimited(spark: SparkSession, path: str | list[str], table: str, multiline: bool = False) -> DataFrame:
    """CSV (also compressed) of a raw table, all strings.

    ``multiline`` allows line breaks inside quotes, at the price of one task per file.
    """
    return _delimited(spark.read, table).option("multiLine", multiline).csv(path)


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One variant row per line; splittable, so the form to land large data in.

    A line that holds an array is one row per element.
    """
    return _elements(_documents(spark.read).json(path))


def read_any(spark: SparkSession, path: str | list[str], table: str, multiline: bool = False) -> DataFrame:
    """Every record of a file drop, also those that can't be read: these have their text in ``MALFORMED`` and no values."""
    if table in schemas.DELIMITED:
        schema = T.StructType([*schemas.business_schema(table).fields, T.StructField(schemas.MALFORMED, T.StringType())])
        options = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.MALFORMED, "multiLine": str(multiline).lower()}
        rows = spark.read.schema(schema).options(**options).csv(path)
        whole = F.col(schemas.MALFORMED).isNull()
        return rows.select(*[F.when(whole, F.col(c)).alias(c) for c in schemas.DELIMITED[table]], schemas.MALFORMED, "_metadata")
    lines = spark.read.text(path).where(F.trim("value") != "")
    read = F.try_parse_json("value")
    rows = lines.select(read.alias(schemas.DOCUMENT_COLUMN), F.when(read.isNull(), F.col("value")).alias(schemas.MALFORMED), "_metadata")
    elements = F.coalesce(F.try_variant_get(F.col(schemas.DOCUMENT_COLUMN), "$", "array<variant>"), F.array(schemas.DOCUMENT_COLUMN))
    return rows.select(F.explode(elements).alias(schemas.DOCUMENT_COLUMN), schemas.MALFORMED, "_metadata")


def array_indent(spark: SparkSession, path: str | list[str]) -> int | None:
    """The indent of the elements of an array that is written over several lines; None for lines of documents."""
    head = [r[0] for r in spark.read.text(path).limit(2).collect()]
    if len(head) == 2 and head[0].strip() == "[":
        return len(head[1]) - len(head[1].lstrip())
    return None


def read_json_arrays(spark: SparkSession, path: str | list[str], indent: int | None = None) -> DataFrame:
    """One variant row per element of the array that each file holds.

    With the ``indent`` that all arrays were written with, every element starts on a line of its own and files are split
    there in one pass.  Otherwise files may be of any layout, each its own, and are split by two passes (``arrays``).
    """
    if indent:
        return _indented_elements(spark, path, indent)
    return arrays.read_json_any(spark, path)


def _indented_elements(spark: SparkSession, path: str | list[str], indent: int) -> DataFrame:
    """Split where an element of the outer array closes: no other brace stands at this depth on a line start."""
    close = "\n" + " " * indent + "}"
    text = F.regexp_replace("value", r"\A\s*\[", "")
    last = F.regexp_extract(text, rf"(?s)\A(.*{close})\s*\]\s*\z", 1)
    element = F.when(last != "", last).otherwise(F.concat(text, F.lit(close)))
    records = spark.read.text(path, lineSep=close + ",").filter(~text.rlike(r"\A\s*\]?\s*\z"))
    return records.select(F.parse_json(element).alias(schemas.DOCUMENT_COLUMN), F.col("_metadata"))


def stream_files(spark: SparkSession, path: str, table: str, array_files: bool = False, **options: str) -> DataFrame:
    """The same readers as a stream of the files that arrive below ``path``; array files come as ``arrays`` cuts them."""
    reader = spark.readStream.options(**options)
    if table in schemas.DELIMITED:
        return _delimited(reader, table).csv(path)
    if array_files:
        return arrays.cut_files(reader, path)
    return _elements(_documents(reader).schema(schemas.business_schema(table)).json(path))


def _elements(documents: DataFrame) -> DataFrame:
    """One row per element of a top-level array, other documents as they are."""
    document = F.col(schemas.DOCUMENT_COLUMN)
    elements = F.coalesce(F.try_variant_get(document, "$", "array<variant>"), F.array(document))
    return documents.select(F.explode(elements).alias(schemas.DOCUMENT_COLUMN), F.col("_metadata"))


def _delimited(reader, table: str):
    return reader.schema(schemas.business_schema(table)).options(**CSV_OPTIONS)


def _documents(reader):
    return reader.option("singleVariantColumn", schemas.DOCUMENT_COLUMN).option("mode", "FAILFAST")
