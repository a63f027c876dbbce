"""Exact dedup by deterministic block naming.

Texts without white space are cut into blocks of fixed size. Distinct blocks are sorted
and get integers as names; then adjacent names are paired, distinct pairs are sorted and
named, and so on until one name is left per document. Names stand for contents one to
one, so two documents share a last name if and only if their texts are equal: no step
trusts a hash.

Contents move once, in the shuffle that makes blocks distinct (combined in the task first,
so a block in a third of all documents is one row per task). Blocks find their names by
a 64-bit hash; hashes that belong to several contents are found from the distinct blocks,
and their blocks find their names by content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.llm.common import free_name, numbered, stored, table, without_blanks

BLOCK_BYTES = 4096


def _hash(block: Column, bits: int) -> Column:
    value = F.xxhash64(block)
    return value if bits == 64 else value.bitwiseAND(F.lit((1 << bits) - 1))


def _sorted_names(frame: DataFrame, *key: str) -> DataFrame:
    return numbered(frame.sortWithinPartitions(*key), "name")


def identities(rows: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """``(row, level, name)`` of each of the ``rows`` ``(row, text)``. Rows have equal
    ``(level, name)`` if and only if their texts are equal up to white space; null is
    empty. ``hash_bits`` below 64 is for tests: it makes hashes collide."""
    whole = rows.select(
        "row", without_blanks(F.coalesce("text", F.lit(""))).cast("binary").alias("whole")
    )
    last = F.greatest(F.ceil(F.length("whole") / F.lit(block_bytes)), F.lit(1)) - 1
    blocks = whole.select(
        "row",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), last.cast("int")),
                lambda i: F.substring(F.col("whole"), i * block_bytes + 1, F.lit(block_bytes)),
            )
        ).alias("pos", "block"),
    ).withColumn("h", _hash(F.col("block"), hash_bits))

    distinct = blocks.groupBy("h", "block").agg(F.lit(0).alias("one"))
    named = stored(_sorted_names(distinct, "h", "block").select("h", "name"), "block-names")
    of_hash = named.groupBy("h").agg(F.min("name").alias("name"), F.count("*").alias("contents"))
    current = (
        blocks.select("row", "pos", "h")
        .join(of_hash, "h")
        .select("row", "pos", "h", F.when(F.col("contents") == 1, F.col("name")).alias("name"))
    )
    current = stored(current, "names")
    if not current.where("name IS NULL").isEmpty():
        shared = of_hash.where("contents > 1").select("h")
        doubtful = blocks.join(shared, "h", "left_semi")
        contents = _sorted_names(
            doubtful.groupBy("h", "block").agg(F.lit(0).alias("one")), "h", "block"
        ).select("h", "block", (-1 - F.col("name")).alias("name"))
        found = doubtful.join(contents, ["h", "block"]).select("row", "pos", "name")
        current = stored(
            current.where("name IS NOT NULL").select("row", "pos", "name").union(found), "names"
        )
    current = current.select("row", "pos", "name")

    level, done = 0, None
    while True:
        longest = current.agg(F.max("pos")).first()[0] or 0
        if longest == 0:
            final = current.select("row", F.lit(level).alias("level"), "name")
            return final if done is None else done.union(final)
        lengths = current.groupBy("row").agg(F.max("pos").alias("last"))
        ended = lengths.where("last = 0").select("row")
        final = current.where("pos = 0").join(ended, "row", "left_semi")
        final = final.select("row", F.lit(level).alias("level"), "name")
        done = final if done is None else done.union(final)
        even = F.col("pos") % 2 == 0
        pairs = (
            current.join(ended, "row", "left_anti")
            .groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("left_name"),
                F.max(F.when(~even, F.col("name"))).alias("right_name"),
            )
        )
        names = _sorted_names(
            pairs.groupBy("left_name", "right_name").agg(F.lit(0).alias("one")),
            "left_name",
            "right_name",
        )
        names = names.select(
            F.col("left_name").alias("l"), F.col("right_name").alias("r"), "name"
        )
        same = F.col("left_name").eqNullSafe(F.col("l")) & F.col("right_name").eqNullSafe(F.col("r"))
        current = stored(pairs.join(names, same).select("row", "pos", "name"), "names")
        level += 1


def exact_groups(documents: DataFrame, block_bytes: int = BLOCK_BYTES, row: str | None = None) -> DataFrame:
    """One row per document: ``row, doc_id, keep_id, group_size, kept, text_sha256``.

    ``documents`` needs ``doc_id`` and ``text``; other columns are not read, but for the one
    that ``row`` names, if any, as what tells the rows apart. Of equal texts the one with the most code points
    stays, then the smallest ``doc_id``, null last, then any one of repeated rows. A null
    text is empty; empty texts are equal. An empty table gives an empty result.
    """
    if row is None:
        rows = numbered(documents.select("doc_id", "text"), "row")
    else:
        rows = documents.select(F.col(row).alias("row"), "doc_id", "text")
    facts = rows.select(
        "row",
        "doc_id",
        F.coalesce(F.length("text"), F.lit(0)).alias("n"),
        F.sha2(without_blanks(F.coalesce("text", F.lit(""))).cast("binary"), 256).alias("text_sha256"),
    )
    members = facts.join(identities(rows, block_bytes), "row")
    members = stored(members, "members")
    order = F.struct(-F.col("n"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = members.groupBy("level", "name").agg(
        F.min_by(F.struct(F.col("row").alias("keep_row"), F.col("doc_id").alias("keep_id")), order).alias("best"),
        F.count("*").alias("group_size"),
    )
    return members.join(groups, ["level", "name"]).select(
        "row",
        "doc_id",
        F.col("best.keep_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.keep_row")).alias("kept"),
        "text_sha256",
    )


def exact_dedup(documents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``documents`` that stay, all their columns. They are read twice and have to come
    in the same order each time, as those of a file scan do."""
    row = free_name(documents, "row")
    rows = numbered(documents, row)
    kept = exact_groups(rows, block_bytes, row).where("kept").select(F.col("row").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents", "doc_id", "text")).drop("row")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       r = first_value(r) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST, r)
"""
