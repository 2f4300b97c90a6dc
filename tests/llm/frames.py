"""Small frames with the awkward cases that every operator must take."""

from pyspark.sql import types as T

WORDS = ("the quick brown fox jumps over one lazy dog while seven wise owls watch from "
         "an old oak tree near a quiet river").split()


def prose(seed: int, n: int = 60) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * (seed % 5 + 1)) % len(WORDS)] + str((seed + i) % 13)
                    for i in range(n))


AWKWARD = [
    (1, None, "en", None), (2, "", None, "a"), (3, " \t\n\x0b ", "en", "a"),
    (None, "no id " + prose(3), "en", "b"), (4, prose(4), "en", "a"), (5, prose(4), "en", "a"),
    (5, prose(4), "en", "a"), (6, prose(6) + " " + prose(6), "de", "b"),
    (7, "\n".join(prose(8, 9) for _ in range(12)), "de", "b"), (8, "x" * 70000, "fr", "c"),
    (9, " ".join(prose(i) for i in range(120)), "fr", "c"), (10, "Ünïcødé ß 日本語 🙂 " * 30, "ja", "c"),
    (11, "one", "en", "a"), (12, "One", "en", "a"), (13, "a\x00b \x1c c d", "en", "a"),
]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])

#: Names that operators use inside.
CLASHES = ("fp n root u v g s lo hi span bucket value score kept hot shard slot size h1 words "
           "n_words weight total path pattern rank count node html ids").split()


def awkward(spark):
    rows = [(*r, *[f"clash {c}" for c in CLASHES]) for r in AWKWARD]
    extra = [T.StructField(c, T.StringType()) for c in CLASHES]
    return spark.createDataFrame(rows, T.StructType(SCHEMA.fields + extra)).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, rows):
    """rows: (doc_id, text)"""
    return spark.createDataFrame([(i, t, None, None) for i, t in rows], SCHEMA)


def sf(spark, table="documents", size="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{size}/{table}.parquet")
