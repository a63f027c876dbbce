"""Prefix trie of conversations from sorted matrices of turn ids.

Every distinct beginning of a conversation is a node. Conversations are sorted by their
turns, so that a node's members are neighbours: a column of turn ids changes from one row
to the next where a node of that depth starts, or one of any depth above it, so the masks
of changes are OR-accumulated from column to column, and what a node sums up is a reduceat
between starts.

Spark sorts into range shards by all turns and then by id, so that a conversation which a
third of all rows repeat is many shards, and numpy does the rest for one shard at a time.
The matrix is padded and taken a few columns at a time, with only the rows that go on, so
one long conversation does not widen it for all. A shard knows how many turns its first and
last row share with the rows next to them in other shards; with that, all sums count what
starts or ends in the shard alone, and the nodes on the paths of these two rows, which other
shards may hold as well, are added up by their name in Spark. All other nodes are whole.

A turn's id is half of the SHA-256 of its role and text, and a node that shards share is
named by the SHA-256 of its turns' ids: the texts themselves are read once and not moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.llm.common import WORD, stored, table

#: Bytes of a turn's id.
ID = 16
#: Turns of a shard, about, and columns of the matrix at a time.
SHARD_TURNS = 100_000
COLUMNS = 16
#: Conversation ids in a piece of the list that names a node's ends.
PIECE = 10_000
#: What repeats the beginning of another conversation: of ``EVERY`` ids the first is the
#: base of the others, which take 0 to 3 turns of it.
EVERY, HEADS = 20, 4

SUMS = ("n_convs", "n_children", "n_leaves", "saved")
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
NODE = (
    "shard int, shared boolean, name string, parent string, parent_conv_id long, conv_id long, depth long, "
    + ", ".join(f"{name} long" for name in SUMS)
    + ", ends_sha256 string, pieces array<struct<first: long, ids: string>>"
)
NOTHING = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)`` of each conversation in ``(conv_id, turn, role, text)``: its turns
    in order as ``(id, words)``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.substring(F.unhex(whole), 1, ID).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    return (
        turns.where("conv_id IS NOT NULL")
        .select("conv_id", turn.alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t.id.alias("id"), t.words.alias("words"))).alias("turns"))
    )


def rebuilt(found: DataFrame) -> DataFrame:
    """The conversations, each with the first ``h`` turns of its base instead of its own."""
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    heads = found.where(F.col("conv_id") % EVERY == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    rows = found.withColumn("h", h.cast("int")).withColumn("base", F.col("conv_id") - F.col("conv_id") % EVERY)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    nothing = F.slice("turns", 1, 0)
    joined = rows.join(heads, "base", "left")
    return joined.select(
        "conv_id", F.concat(F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h")), own).alias("turns")
    )


def _shared_turns(a: Column, b: Column) -> Column:
    """How many turns two sequences of ids begin with that are the same."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same))


def sharded(found: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """``(shard, conv_id, ids, words, before, after)``: conversations in range shards; what
    the shard's first row shares with the one before it, and its last with the one after."""
    total = found.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    rows = found.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"))
    rows = rows.repartitionByRange(-(-total // shard_turns) or 1, "ids", "conv_id")
    rows = stored(rows.select(F.spark_partition_id().alias("shard"), "*"), "trie-shards")
    row = F.struct("ids", "conv_id")
    ends = stored(rows.groupBy("shard").agg(F.min(row).alias("first"), F.max(row).alias("last")), "shard-ends")
    # The driver gets the numbers of the shards that have rows, each the number of a task.
    shards = sorted(r.shard for r in ends.select("shard").collect())
    beside = found.sparkSession.createDataFrame(list(zip(shards[:-1], shards[1:], strict=True)), "a int, b int")
    left = ends.select(F.col("shard").alias("a"), F.col("last.ids").alias("x"))
    right = ends.select(F.col("shard").alias("b"), F.col("first.ids").alias("y"))
    shared = beside.join(left, "a").join(right, "b").select("a", "b", _shared_turns(F.col("x"), F.col("y")).alias("n"))
    shared = stored(shared, "shared-turns")
    none = F.lit(-1).cast("int")
    return (
        rows.join(shared.select(F.col("b").alias("shard"), F.col("n").alias("before")), "shard", "left")
        .join(shared.select(F.col("a").alias("shard"), F.col("n").alias("after")), "shard", "left")
        .select("shard", "conv_id", "ids", "words", F.coalesce("before", none).alias("before"), F.coalesce("after", none).alias("after"))
    )


def _turn_numbers(ids: pa.ListArray) -> np.ndarray:
    """Numbers of the turns of all rows, in the order of their ids, which are told apart."""
    flat = ids.flatten()
    halves = np.frombuffer(b"".join(flat.to_pylist()), ">u8").reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    ranked = halves[order]
    new = np.ones(len(order), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.cumsum(new) - 1
    return numbers


def _ordered(numbers: np.ndarray, begins: np.ndarray, sizes: np.ndarray, conv: np.ndarray):
    """The rows in order of their turns and ids; how many turns each shares with the one before.

    Rows that go on beyond a block of columns keep their places as a group, behind those that
    end there, and are sorted among themselves by the next block.
    """
    order = np.argsort(conv, kind="stable")
    shared = np.zeros(len(order), np.int64)
    at, group, first = np.arange(len(order)), np.zeros(len(order), np.int64), 0
    columns = np.arange(COLUMNS)
    while len(at):
        rows = order[at]
        inside = first + columns < sizes[rows][:, None]
        matrix = np.full(inside.shape, -1, np.int64)
        matrix[inside] = numbers[(begins[rows][:, None] + first + columns)[inside]]
        goes_on = sizes[rows] > first + COLUMNS
        by = np.lexsort((goes_on, *matrix.T[::-1], group))
        rows, matrix, group, goes_on = rows[by], matrix[by], group[by], goes_on[by]
        order[at] = rows
        changed = np.ones(len(at), bool)
        changed[1:] = group[1:] != group[:-1]
        new = changed.copy()
        for column in matrix.T:
            # A row's first change is where its own nodes begin; before it, it shares.
            new[1:] |= column[1:] != column[:-1]
            shared[at[~new & (column >= 0)]] += 1
        new[1:] |= goes_on[1:] != goes_on[:-1]
        group = np.cumsum(new)[goes_on]
        at = at[goes_on]
        first += COLUMNS
    return order, shared


def _path(ids: list[bytes], depth: int) -> list[str]:
    """Names of the nodes on a path, from the root to ``depth``."""
    names = [NOTHING]
    for turn in ids[:depth]:
        names.append(hashlib.sha256(names[-1].encode() + turn).hexdigest())
    return names


def _ids_hash(conv: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, conv.tolist())).encode()).hexdigest()


def shard_nodes(rows: pa.Table) -> pa.Table:
    """The nodes that the conversations of one shard are members of, as ``NODE`` has them.
    What a shared node sums up is this shard's part of it."""
    rows = rows.combine_chunks()
    conv = rows.column("conv_id").to_numpy()
    ids, words = (rows.column(n).combine_chunks() for n in ("ids", "words"))
    shard, before, after = (rows.column(n)[0].as_py() for n in ("shard", "before", "after"))
    offsets = ids.offsets.to_numpy().astype(np.int64)
    begins, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    order, lcp = _ordered(_turn_numbers(ids), begins, sizes, conv)
    conv, begins, sizes = conv[order], begins[order], sizes[order]
    last = len(conv) - 1
    lcp[0] = before
    next_lcp = np.append(lcp[1:], after)
    leaf = (next_lcp < sizes).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(words.flatten().to_numpy(), dtype=np.int64)])
    # Words of the turns that a row only shares: each node's are saved for all but its first.
    shared_words = total[begins + np.maximum(lcp, 0)]
    first_path, last_path = (
        _path(ids[int(order[row])].as_py(), depth) if depth >= 0 else [] for row, depth in ((0, before), (last, after))
    )

    columns: dict[str, list] = {field: [] for field in rows_schema().names}
    members, above = np.arange(len(conv)), None
    depth = 0
    while len(members):
        starts = np.flatnonzero(lcp[members] < depth)
        if not len(starts) or starts[0]:
            starts = np.append(0, starts)
        place = members[starts]
        ends = np.append(members[starts[1:] - 1], members[-1])
        smallest = np.minimum.reduceat(conv[members], starts)
        child = (sizes[members] > depth) & (lcp[members] <= depth)
        saved = np.maximum(shared_words[members] - total[begins[members] + max(depth - 1, 0)], 0)
        here = sizes[members] == depth
        stop = np.cumsum(here)
        n_here = np.add.reduceat(here.astype(np.int64), starts)
        first_shared = (place == 0) & (before >= depth)
        last_shared = (ends == last) & (after >= depth)
        shared = first_shared | last_shared
        names: list[str | None] = [None] * len(starts)
        for which, path in ((first_shared, first_path), (last_shared, last_path)):
            for i in np.flatnonzero(which):
                names[i] = path[depth]
        hashes: list[str | None] = [NOTHING] * len(starts)
        pieces: list[list | None] = [None] * len(starts)
        for i in np.flatnonzero((n_here > 0) | shared).tolist():
            ended = conv[place[i] : place[i] + n_here[i]]
            if shared[i]:
                hashes[i] = None
                pieces[i] = [
                    {"first": int(ended[k]), "ids": ",".join(map(str, ended[k : k + PIECE].tolist()))}
                    for k in range(0, len(ended), PIECE)
                ]
            else:
                hashes[i] = _ids_hash(ended)
        if above is None:
            parents, parent_conv = [None] * len(starts), np.full(len(starts), None)
        else:
            of = np.searchsorted(above[0], place, "right") - 1
            parents = [above[1][k] for k in of]
            parent_conv = np.where([p is None for p in parents], above[2][of].astype(object), None)
        columns["shared"] += shared.tolist()
        columns["name"] += names
        columns["parent"] += parents
        columns["parent_conv_id"] += parent_conv.tolist()
        columns["conv_id"] += smallest.tolist()
        columns["depth"] += [depth] * len(starts)
        for name, values in (
            ("n_convs", np.ones(len(members), np.int64)),
            ("n_children", child.astype(np.int64)),
            ("n_leaves", leaf[members]),
            ("saved_tokens", saved),
        ):
            columns[name] += np.add.reduceat(values, starts).tolist()
        columns["ends_sha256"] += hashes
        columns["pieces"] += pieces
        above = (place, names, smallest)
        depth += 1
        members = members[sizes[members] >= depth]
    columns["shard"] = [shard] * len(columns["depth"])
    return pa.table(columns, schema=rows_schema())


def rows_schema() -> pa.Schema:
    piece = pa.struct([("first", pa.int64()), ("ids", pa.string())])
    return pa.schema(
        [("shard", pa.int32()), ("shared", pa.bool_()), ("name", pa.string()), ("parent", pa.string())]
        + [(n, pa.int64()) for n in ("parent_conv_id", "conv_id", "depth", *SUMS)]
        + [("ends_sha256", pa.string()), ("pieces", pa.list_(piece))]
    )


def _hash_lists(pieces: DataFrame) -> DataFrame:
    """``(name, ends_sha256)`` of the comma-joined ``(name, first, ids)`` of each name, in
    order of ``first``: read as a stream, since a list may be as long as the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None
        for batch in batches:
            names, hashes = [], []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own != name:
                    if name is not None:
                        names.append(name)
                        hashes.append(digest.hexdigest())
                    name, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(hashes, pa.string())], ["name", "ends_sha256"])
        if name is not None:
            yield pa.RecordBatch.from_pydict({"name": [name], "ends_sha256": [digest.hexdigest()]})

    ordered = pieces.repartition("name").sortWithinPartitions("name", "first")
    return ordered.select("name", "ids").mapInArrow(run, "name string, ends_sha256 string")


def prefix_trie(found: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of the conversations ``(conv_id, turns)``, ids distinct
    and ``turns`` an array of ``(id, words)``: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``. Conversations without turns are members of the root; without any
    conversation there is no node."""
    rows = sharded(stored(found, "trie-conversations"), shard_turns)
    nodes = stored(rows.groupBy("shard").applyInArrow(shard_nodes, NODE), "trie-nodes")
    parts = nodes.where("shared")
    digests = _hash_lists(parts.select("name", F.inline("pieces")))
    whole = (
        parts.groupBy("name")
        .agg(
            F.min("parent").alias("parent"),
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            *[F.sum(name).alias(name) for name in SUMS],
        )
        .join(digests, "name", "left")
    )
    whole = stored(whole, "shared-nodes")
    columns = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]
    above = whole.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joined = whole.join(above, "parent", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    # A node that is whole finds a shared parent by the shard too: all shards have a root.
    near = parts.select("shard", F.col("name").alias("parent")).distinct()
    near = near.join(above, "parent").withColumnRenamed("parent_conv_id", "found")
    rest = nodes.where("NOT shared").join(near, ["shard", "parent"], "left")
    rest = rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "found"))
    return rest.select(*columns).unionByName(joined.select(*columns))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefix_trie(rebuilt(stored(sequences(turns), "conversations")))


#: CRC-32 of the decimal id: each byte, then eight steps of a bit.
_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda b: ascii(b)::BIGINT)), "
    "lambda s, b: list_reduce(list_prepend(xor(s, b), [0,0,0,0,0,0,0,0]::BIGINT[]), "
    "lambda x, o: xor(x >> 1, 3988292384 * (x & 1)))))"
)
SQL = rf"""
WITH o AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
         ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, ({_CRC} % 4)::INTEGER AS h FROM o),
r AS (SELECT h.c, list_concat(coalesce(list_slice(b.turns, 1, h.h), []), list_slice(h.turns, h.h + 1, len(h.turns))) AS turns
      FROM h LEFT JOIN o AS b ON b.c = h.c - h.c % 20),
m AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS depth FROM r),
n AS (SELECT depth, list_slice(turns, 1, depth) AS node, min(c) AS conv_id, count(*) AS n_convs,
             string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(turns) = depth) AS ends FROM m GROUP BY 1, 2),
w AS (SELECT *, list_slice(node, 1, depth - 1) AS above,
             CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(node[depth].text, '[^ 	-
]+')) END AS own,
      FROM n),
k AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM w WHERE depth > 0 GROUP BY 1, 2),
l AS (SELECT w.*, coalesce(n_children, 0) AS n_children FROM w LEFT JOIN k USING (depth, node)),
u AS (SELECT d AS depth, list_slice(node, 1, d) AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM l) GROUP BY 1, 2)
SELECT l.conv_id, l.depth, p.conv_id AS parent_conv_id, l.n_convs, l.n_children, u.n_leaves, u.saved_tokens,
       sha256(coalesce(l.ends, '')) AS ends_sha256
FROM l JOIN u USING (depth, node) LEFT JOIN n AS p ON p.depth = l.depth - 1 AND p.node = l.above
"""
