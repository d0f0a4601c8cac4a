"""Exact copies: groups by a 128-bit hash of the content, confirmed byte by byte.

1. Every row is reduced once to (id, hash, SHA-256), a narrow table in the shared folder; groups are its aggregate by
   hash, which combines before the shuffle, so a text that makes up a third of all rows is one row per task.
2. Only rows of groups of two or more carry their text on: each is compared with the text of the row that its group
   would keep. Rows of one group meet that one text in a join, which adaptive execution splits where a group is hot.
3. A row whose bytes differ has the hash but not the text of its group. Such rows are grouped again by the text itself.

The row with the largest id stays (``largest=False``: the smallest). Equality is after lower-casing A-Z. Null is the
empty text, and a null id is smaller than all others. Repeated rows (equal id and equal text) all carry the same
answer; ``copies_removed`` leaves one of them. An empty table has an empty result. Columns beside the two named ones
are not read, whatever their names. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.ascii import lower_ascii
from scoreloom.session import written


def content_hash(text: Column) -> Column:
    return F.md5(text)


def copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = True, digest=content_hash
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    best = F.max if largest else F.min
    plain = docs.select(F.col(f"`{key}`").alias("id"), lower_ascii(F.col(f"`{text}`")).alias("norm"))
    hashed = written(
        plain.select("id", digest(F.col("norm")).alias("hash"), F.sha2("norm", 256).alias("sha")), "hashed"
    )
    several = (
        hashed.groupBy("hash").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )
    members = written(
        plain.withColumn("hash", digest(F.col("norm"))).join(several.select("hash", "keep_id"), "hash"), "members"
    )
    keepers = (
        members.where(F.col("id").eqNullSafe(F.col("keep_id")))
        .groupBy("hash").agg(F.min("norm").alias("keep_norm"))
    )
    differing = written(
        members.join(keepers, "hash").where("norm != keep_norm").select("hash", "id", "norm"), "differing"
    )
    own = differing.groupBy("hash", "norm").agg(best("id").alias("own_keep"), F.count(F.lit(1)).alias("own_size"))
    moved = own.select("hash", F.sha2("norm", 256).alias("sha"), "own_keep", "own_size")
    gone = own.groupBy("hash").agg(F.sum("own_size").alias("gone"))
    size = F.coalesce("own_size", F.col("group_size") - F.coalesce("gone", F.lit(0)), F.lit(1))
    keep_id = F.when(F.col("own_size").isNotNull(), F.col("own_keep")).otherwise(
        F.when(F.col("group_size").isNotNull(), F.col("keep_id")).otherwise(F.col("id"))
    )
    return (
        hashed.join(several, "hash", "left").join(gone, "hash", "left").join(moved, ["hash", "sha"], "left")
        .select(
            F.col("id").alias(key),
            keep_id.alias("keep_id"),
            size.cast("long").alias("group_size"),
            F.col("id").eqNullSafe(keep_id).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def copies_removed(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = True) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with the columns of ``docs``."""
    kept = copies(docs, key, text, largest).where("kept").groupBy(key, "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    helpers = ["id", "sha", "n"]
    while any(h in docs.columns for h in helpers):  # names that no column of docs has
        helpers = [f"_{h}" for h in helpers]
    id_, sha_, n = helpers
    sha = F.sha2(lower_ascii(F.col(f"`{text}`")), 256)
    kept = kept.select(F.col(key).alias(id_), F.col("text_sha256").alias(sha_), F.col("n").alias(n))
    rows = docs.join(kept, F.col(f"`{key}`").eqNullSafe(F.col(id_)) & (sha == F.col(sha_)))
    once = rows.where(F.col(n) == 1).select(docs.columns)
    repeated = rows.where(F.col(n) > 1).dropDuplicates([id_, sha_]).select(docs.columns)
    return once.unionByName(repeated)
