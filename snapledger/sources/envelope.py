"""Envelope scan: one row per element of an array nested in a JSON document.

Elements are read as ``MAP<STRING, STRING>``.  Every scalar therefore arrives as text and is
coerced later by explicit rules, nested values arrive as JSON text, and a field that is
absent can be told apart from one that is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .landing import LANDED_GLOB

ENTITY = T.MapType(T.StringType(), T.StringType())


class MissingColumns(ValueError):
    """A feed lacks columns that the transformation reads."""


def _document_type(array_path: str, entity: T.DataType = ENTITY) -> T.StructType:
    kind: T.DataType = T.ArrayType(entity)
    for name in reversed(array_path.split(".")):
        kind = T.StructType([T.StructField(name, kind)])
    return kind


def read_envelope(spark: SparkSession, paths: str | Sequence[str],
                  array_path: str = "data.stations", glob: str = LANDED_GLOB) -> DataFrame:
    """``file, file_time, pos, entity`` for every element of every document under ``paths``.

    A document whose array is empty leaves one row with null ``pos`` and ``entity``, so that a
    snapshot without elements can be told from no snapshot.  One document is one record and one task's work at a time: parallelism comes from the
    number of documents.  A damaged document fails the read.
    """
    return explode_payload(read_documents(spark, paths, glob), "payload", array_path,
                           keep_empty=True)


def read_documents(spark: SparkSession, paths: str | Sequence[str], glob: str = LANDED_GLOB) -> DataFrame:
    """``file, file_time, payload`` of whole documents, not looked into."""
    return _documents(spark.read, paths, glob)


def stream_documents(spark: SparkSession, path: str, glob: str = LANDED_GLOB,
                     max_files: int | None = None) -> DataFrame:
    """Streaming counterpart of :func:`read_documents`: every landed document is read once."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _documents(reader, path, glob)


def stream_envelope(spark: SparkSession, path: str, array_path: str = "data.stations",
                    glob: str = LANDED_GLOB, max_files: int | None = None) -> DataFrame:
    """Streaming counterpart of :func:`read_envelope`: every landed document is read once."""
    return explode_payload(stream_documents(spark, path, glob, max_files), "payload", array_path,
                           keep_empty=True)


def _documents(reader, paths: str | Sequence[str], glob: str) -> DataFrame:
    """Whole documents as text, with file name and time.

    The JSON source in multi-line mode would do the same, but was found far slower when numbers
    are wanted as text.
    """
    files = (reader.format("text").option("wholetext", True)
             .option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(paths))
    return files.select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_modification_time").alias("file_time"),
                        F.col("value").alias("payload"))


def explode_payload(df: DataFrame, payload: str, array_path: str = "data.stations",
                    keep_empty: bool = False, values: str = "string") -> DataFrame:
    """Elements of the documents held in a text column; the other columns are kept.

    A document without the array is an error, not an empty snapshot.  With ``keep_empty`` an
    empty snapshot leaves one row with null ``pos`` and ``entity``.  ``values`` may be ``variant``,
    to keep the JSON type of each field.
    """
    entity = T.MapType(T.StringType(), T.VariantType() if values == "variant" else T.StringType())
    origin = [c for c in df.columns if c != payload]
    parsed = df.select(*origin, F.from_json(payload, _document_type(array_path, entity),
                                            {"mode": "FAILFAST"}).alias("document"))
    missing = F.raise_error(F.lit(f"document without {array_path}")).cast(T.ArrayType(entity))
    elements = F.coalesce(F.col(f"document.{array_path}"), missing)
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return parsed.select(*origin, explode(elements).alias("pos", "entity"))


def sort_out(documents: DataFrame, payload: str = "payload",
             array_path: str = "data.stations") -> tuple[DataFrame, DataFrame]:
    """The sound documents, and the damaged ones with a ``reason``; both as they came.

    Damaged is what :func:`explode_payload` would stop at: text that is no JSON document of that
    shape, and a document without the array.
    """
    kind = _document_type(array_path)
    kind = T.StructType([*kind.fields, T.StructField("_damaged", T.StringType())])
    parsed = F.from_json(payload, kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged"})
    reason = (F.when(F.col(payload).isNull() | (F.trim(payload) == ""), "empty document")
              .when(F.col("_document._damaged").isNotNull(), "malformed document")
              .when(F.col(f"_document.{array_path}").isNull(), f"document without {array_path}"))
    judged = documents.withColumn("_document", parsed).withColumn("reason", reason).drop("_document")
    return (judged.filter(F.col("reason").isNull()).drop("reason"),
            judged.filter(F.col("reason").isNotNull()))


def present_columns(df: DataFrame, expected: Sequence[str], entity: str = "entity") -> list[str]:
    """Which of ``expected`` occur in at least one element: one aggregate, one row back."""
    row = df.agg(*[F.bool_or(F.map_contains_key(entity, name)).alias(f"c{i}")
                   for i, name in enumerate(expected)]).first()
    return [name for i, name in enumerate(expected) if row[i]]


def entity_columns(df: DataFrame, names: Sequence[str], entity: str = "entity") -> DataFrame:
    """Replace the entity map by one text column per name."""
    kept = [c for c in df.columns if c != entity]
    return df.select(*kept, *[F.try_element_at(F.col(entity), F.lit(n)).alias(n) for n in names])


def project_required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Projection that names what is missing instead of yielding nulls."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {missing}")
    return df.select(*names)
