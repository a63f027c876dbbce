"""Chat formatting after the collapse of cumulative snapshots.

Logs often hold a conversation once per turn, each snapshot with all turns so far. Rolling
hashes of the turns name every prefix of a conversation: a conversation whose last hash is
an earlier one of another is a snapshot of it. An anti-join drops these, of equal
conversations the smallest id stays, and what is left is rendered.

Hashes are SHA-256, so equal ones are equal prefixes. A conversation is one row, as its
rendered text is. The sides of the anti-join are made distinct first (combined in the task),
so a first turn that a third of all conversations share is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.llm.common import stored, table

START, END = "<|im_start|>", "<|im_end|>"
UNKNOWN_ROLE = "unknown"


def conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: the turns of each conversation in order, from the rows
    ``(conv_id, turn, role, text)``.

    Rows that repeat are one turn; different rows with the same number are turns in order
    of role and text, a null number is first. A null text is empty, a null role unknown.
    Rows without ``conv_id`` cannot be put together: each is a conversation of one turn.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit(UNKNOWN_ROLE)).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    whole = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.sort_array(F.collect_set(turn)).alias("turns")
    )
    alone = turns.where("conv_id IS NULL").select("conv_id", F.array(turn).alias("turns"))
    return whole.unionByName(alone)


def _prefix_hashes(turns: Column) -> Column:
    """The rolling hash after each turn; role and text are told apart by their lengths."""

    def add(hashes: Column, turn: Column) -> Column:
        before = F.coalesce(F.try_element_at(hashes, F.lit(-1)), F.lit(""))
        now = F.sha2(F.concat(before, F.length(turn.role).cast("string"), F.lit(":"), turn.role, turn.text), 256)
        return F.concat(hashes, F.array(now))

    return F.aggregate(turns, F.array().cast("array<string>"), add)


def maximal(found: DataFrame) -> DataFrame:
    """Those of the conversations ``(conv_id, turns)`` that are no prefix of a longer one;
    of equal ones the one with the smallest ``conv_id``, null last."""
    hashed = stored(found.withColumn("hashes", _prefix_hashes(F.col("turns"))), "conversations")
    hashed = hashed.withColumn("last", F.element_at("hashes", -1))
    prefixes = hashed.select(
        F.explode(F.slice("hashes", 1, F.size("hashes") - 1)).alias("last")
    ).distinct()
    whole = hashed.groupBy("last").agg(F.min("conv_id").alias("first"), F.count("*").alias("copies"))
    ends = whole.join(prefixes, "last", "left_anti")
    of_id = hashed.join(ends.where("first IS NOT NULL").select(F.col("first").alias("conv_id"), "last"), ["conv_id", "last"])
    # Without any id one of the equal ones is left, whichever: their turns are the same.
    unnamed = hashed.where("conv_id IS NULL").join(ends.where("first IS NULL").select("last"), "last", "left_semi")
    unnamed = unnamed.groupBy("last").agg(F.any_value("turns").alias("turns"))
    return of_id.select("conv_id", "turns").unionByName(
        unnamed.select(F.lit(None).cast(found.schema["conv_id"].dataType).alias("conv_id"), "turns")
    )


def _plain(text: Column) -> Column:
    """Markers within a text are broken, so that they mark nothing."""
    return F.replace(text, F.lit("<|im_"), F.lit("<| im_"))


def rendered(found: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, text, answer_chars)``: each conversation as one text with marked
    turns, and how many code points the assistant's answers have in it."""

    def turn(t: Column) -> Column:
        return F.concat(F.lit(START), _plain(t.role), F.lit("\n"), _plain(t.text), F.lit(END), F.lit("\n"))

    answers = F.filter("turns", lambda t: t.role == "assistant")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", turn), "").alias("text"),
        F.aggregate(
            answers, F.lit(0).cast("long"), lambda n, t: n + F.length(_plain(t.text))
        ).alias("answer_chars"),
    )


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return rendered(maximal(conversations(turns)))


SQL = f"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '{UNKNOWN_ROLE}') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT list_slice(turns, 1, k) AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM c)),
m AS (SELECT min(conv_id) AS conv_id, turns FROM c GROUP BY turns HAVING turns NOT IN (SELECT turns FROM p))
SELECT conv_id, len(turns)::BIGINT AS n_turns,
       list_aggregate(list_transform(turns, lambda x: '{START}' || replace(x.role, '<|im_', '<| im_') || chr(10)
         || replace(x.text, '<|im_', '<| im_') || '{END}' || chr(10)), 'string_agg', '') AS text,
       coalesce(list_sum(list_transform(list_filter(turns, lambda x: x.role = 'assistant'),
         lambda x: length(replace(x.text, '<|im_', '<| im_')))), 0)::BIGINT AS answer_chars
FROM m
"""
