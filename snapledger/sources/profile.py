"""What a feed contains, computed over all landed documents rather than one sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .envelope import explode_payload


def feed_profile(df: DataFrame, payload: str, array_path: str = "data.stations") -> DataFrame:
    """Per document: its keys, the keys of the array's parent, element count, first element.

    The count is NULL, not 0, where the array is missing or the document cannot be read.
    """
    parent, _, _ = array_path.rpartition(".")
    others = [c for c in df.columns if c != payload]
    text = F.col(payload)
    elements = F.get_json_object(text, f"$.{array_path}")
    return df.select(
        *others,
        F.json_object_keys(text).alias("document_keys"),
        F.json_object_keys(F.get_json_object(text, f"$.{parent}") if parent else text)
        .alias("parent_keys"),
        F.json_array_length(elements).alias("element_count"),
        F.get_json_object(text, f"$.{array_path}[0]").alias("first_element"))


def element_profile(df: DataFrame, payload: str, array_path: str = "data.stations") -> DataFrame:
    """Per element column, over all documents: occurrences, nulls and inferred type."""
    elements = explode_payload(df.select(payload), payload, array_path, values="variant")
    fields = elements.select(F.explode("entity").alias("key", "value"))
    return _summarise(fields)


def document_structure(df: DataFrame, payload: str, array_path: str = "data.stations") -> DataFrame:
    """Per document: ``structure``, the type of each field that an element of it has.

    Types are those of the JSON values, one for all elements, numbers with a fraction DOUBLE; a
    field that is null in all is VOID.
    Documents that cannot be read have an empty structure, like those without elements.
    """
    others = [c for c in df.columns if c != payload]
    elements = F.get_json_object(payload, f"$.{array_path}")
    fields = df.select(*others, F.explode_outer(F.from_json(
        elements, "array<map<string,variant>>")).alias("entity")).select(
        *others, F.explode_outer("entity").alias("key", "value"))
    typed = fields.groupBy(*others, "key").agg(_kind("value").alias("kind"))
    named = F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", "kind")))
    return typed.groupBy(*others).agg(F.map_from_entries(F.array_sort(named)).alias("structure"))


def drift(structures: DataFrame, feed: list[str], order: list[str]) -> DataFrame:
    """What changes from one snapshot of a feed to the next one that has fields at all.

    ``structures`` is a frame of :func:`document_structure` with columns that name the ``feed``
    and ``order`` its snapshots.  One row for each change: ``key``, ``change`` (``added``,
    ``removed``, ``type``), ``before`` and ``after`` (types).  A type VOID, of values all null, is
    no change of type.  One feed's snapshots are ordered in one task, each as one small map.
    """
    known = structures.filter(F.size("structure") > 0)
    within = Window.partitionBy(*feed).orderBy(*order)
    pairs = known.withColumn("was", F.lag("structure").over(within)).filter(F.col("was").isNotNull())
    keys = F.array_union(F.map_keys("was"), F.map_keys("structure"))
    fields = pairs.select(*feed, *order, F.explode(keys).alias("key"), "was", "structure")
    compared = fields.select(*feed, *order, "key", F.try_element_at("was", F.col("key")).alias("before"),
                             F.try_element_at("structure", F.col("key")).alias("after"))
    change = (F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed")
              .when((F.col("before") != F.col("after")) & (F.col("before") != "VOID")
                    & (F.col("after") != "VOID"), "type"))
    return compared.withColumn("change", change).filter(F.col("change").isNotNull())


def json_key_profile(df: DataFrame, column: str) -> DataFrame:
    """The same summary for a column that holds one flat JSON object per row.

    Texts that cannot be read as an object are counted in a row whose key is NULL.
    """
    parsed = df.filter(F.col(column).isNotNull()).select(
        F.from_json(column, "map<string,variant>").alias("entity"))
    damaged = F.col("entity").isNull()
    fields = parsed.select(damaged.alias("damaged"),
                           F.explode_outer("entity").alias("key", "value"))
    # An empty object has neither a key nor damage.
    return _summarise(fields.filter(F.col("key").isNotNull() | F.col("damaged")))


def _summarise(fields: DataFrame) -> DataFrame:
    return fields.groupBy("key").agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.count_if(F.col("value").isNull() | F.is_variant_null("value")).alias("nulls"),
        _kind("value").alias("inferred_type"))


def _kind(value: str) -> Column:
    """The common type of JSON values; decimals of any width are DOUBLE."""
    return F.regexp_replace(F.schema_of_variant_agg(value), r"DECIMAL\(\d+,\d+\)", "DOUBLE")
