"""Exact duplicates, safe against skew, in DataFrame operations only.

Equal texts are found in three rounds: each map task combines the equal texts of its own rows, the
combined rows meet per digest, text and salt, and the at most `salts` winners of a text meet once more.
Every round groups by digest *and* text, so texts are compared whole and a digest alone decides nothing.

Defined results: a null text is an empty text. A null doc_id loses to every other one. Repeated rows
(one doc_id) count as rows in `group_size` and share their decision; `deduplicate` keeps one of them.
An empty table gives an empty table. Other columns are neither read nor in the way.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import fresh, squeezed
from tillcast.session import cut_lineage

SALTS = 64

# A winner is the largest (code points, then smallest doc_id). Both as one number, since hash aggregation
# keeps numbers in place but would sort whole texts for a struct. 2^65 leaves room for 2^63 - doc_id.
_SHIFT = "36893488147419103232"
_TOP = "9223372036854775808"


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _rank(text: Column, doc_id: Column) -> Column:
    length = F.length(F.coalesce(text, F.lit(""))).cast("decimal(10,0)")
    small = F.lit(_TOP).cast("decimal(20,0)") - doc_id.cast("decimal(20,0)")
    return (length * F.lit(_SHIFT).cast("decimal(20,0)") + F.coalesce(small, F.lit(0))).cast("decimal(38,0)")


def _doc_id(rank: Column) -> Column:
    small = rank % F.lit(_SHIFT).cast("decimal(20,0)")
    return F.when(small > 0, (F.lit(_TOP).cast("decimal(20,0)") - small).cast("long"))


def _rows(docs: DataFrame, digest, salts: int) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.col("text"), squeezed(F.col("text")).alias("content")).select(
        "doc_id", digest(F.col("content")).alias("text_sha256"), "content",
        _rank(F.col("text"), F.col("doc_id")).alias("rank"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
    )


def _winners(rows: DataFrame) -> DataFrame:
    """A row for each different text: digest, text, rows of it, rank of the one that stays."""
    salted = rows.groupBy("text_sha256", "content", "salt").agg(
        F.count(F.lit(1)).alias("group_size"), F.max("rank").alias("rank")
    )
    # Dealt by digest alone, so that texts which share a digest can be counted without another shuffle.
    return salted.repartition("text_sha256").groupBy("text_sha256", "content").agg(
        F.sum("group_size").alias("group_size"), F.max("rank").alias("rank")
    )


def duplicate_groups(docs: DataFrame, salts: int = SALTS, digest=sha256) -> DataFrame:
    """One row per document: doc_id, keep_id (the row of its group that stays: most code points, then
    smallest doc_id), group_size, kept, text_sha256."""
    rows = _rows(docs, digest, salts)
    by_digest = _winners(rows).groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("contents"), F.max("rank").alias("rank"), F.sum("group_size").alias("group_size")
    )
    groups = cut_lineage(by_digest.filter("group_size > 1"))
    plain = groups.filter("contents = 1").select(
        "text_sha256", _doc_id(F.col("rank")).alias("keep_id"), "group_size", F.lit(True).alias("grouped")
    )
    shared = groups.filter("contents > 1").select("text_sha256")
    members = rows.select("doc_id", "text_sha256")
    if shared.isEmpty():
        found = members.join(plain, "text_sha256", "left")
    else:
        # Different texts under one digest: those rows meet by their texts.
        unsure = rows.join(shared, "text_sha256", "left_semi")
        exact = _winners(unsure).select(
            "text_sha256", "content", _doc_id(F.col("rank")).alias("keep_id"), "group_size", F.lit(True).alias("grouped")
        )
        found = members.join(shared, "text_sha256", "left_anti").join(plain, "text_sha256", "left").unionByName(
            unsure.join(exact, ["text_sha256", "content"]).select(
                "text_sha256", "doc_id", "keep_id", "group_size", "grouped"
            )
        )
    keep = F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256",
    )


def deduplicate(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of `docs` that stay, one for each different text, with all their columns."""
    key = fresh(docs, "dedup_key")
    name = F.concat_ws(":", F.col("doc_id").cast("string"), sha256(squeezed(F.col("text"))))
    kept = duplicate_groups(docs, salts).filter("kept").select(
        F.concat_ws(":", F.col("doc_id").cast("string"), "text_sha256").alias(key)
    )
    place = fresh(docs, "dedup_place")
    longest = Window.partitionBy(key).orderBy(F.length("text").desc_nulls_last())
    return (
        docs.withColumn(key, name).join(kept, key, "left_semi")
        .withColumn(place, F.row_number().over(longest)).filter(F.col(place) == 1).select(*docs.columns)
    )
