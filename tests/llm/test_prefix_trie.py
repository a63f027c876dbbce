"""The trie of conversations against a plain trie of dictionaries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from cabtally.llm import prefix_trie
from cabtally.llm.prefix_trie import prefix_trie as trie_of
from cabtally.llm.prefix_trie import rebuilt, sequences

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The trie's rows, from conversations as a dictionary of lists of (role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    # Turns of the same number are in the order of the operator's ids.
    code = lambda t: hashlib.sha256(f"{len(t[0])}:{t[0]}{t[1]}".encode()).digest()[:16]
    own = {c: [t for _, t in sorted(ts, key=lambda x: (x[0], code(x[1])))] for c, ts in own.items()}
    members = defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        whole = tuple(own.get(conv - conv % 20, [])[:h] + turns[h:])
        for depth in range(len(whole) + 1):
            members[whole[:depth]].append((conv, len(whole) == depth))
    children, leaves, saved = defaultdict(set), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    for node, found in members.items():
        cost = (len(found) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += cost
    smallest = {node: min(c for c, _ in found) for node, found in members.items()}
    return sorted(
        (
            smallest[node],
            len(node),
            smallest[node[:-1]] if node else -1,
            len(found),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(c for c, ends in found if ends)).encode()).hexdigest(),
        )
        for node, found in members.items()
    )


def found(spark, rows, shard_turns):
    turns = rows if not isinstance(rows, list) else spark.createDataFrame(rows, SCHEMA)
    nodes = trie_of(rebuilt(sequences(turns)), shard_turns)
    assert nodes.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in row) for row in nodes.collect())


def made(seed, n=200, words=3, turns=6):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(3 * n), n):
        for turn in range(rng.randrange(1, turns)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), " ".join("ab" for _ in range(rng.randrange(words)))))
    return rows


@pytest.mark.parametrize("shard_turns", [10, 60, 100_000])
def test_equals_a_plain_trie(spark, shard_turns):
    rows = made(shard_turns)
    assert found(spark, rows, shard_turns) == plain(rows)


def test_given_table(spark, small, rows_of):
    rows = rows_of("conversations", "conv_id, turn, role, text")
    turns = spark.read.parquet(f"{small}/conversations.parquet")
    assert found(spark, turns, 25) == plain(rows)


def test_copies_of_one_conversation_over_many_shards(spark):
    rows = [(20 * c + 7, t, "user", f"turn {t}") for c in range(150) for t in range(5)]
    rows += [(20 * c + 7, t, "user", f"turn {t} {c % 3}") for c in range(200, 230) for t in range(4)]
    assert found(spark, rows, 30) == plain(rows)


def test_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "COLUMNS", 4)
    rows = [(c, t, "user", f"turn {t}") for c in (20, 40, 60) for t in range(60 + c)]
    rows += [(80, t, "user", f"turn {t if t < 59 else -t}") for t in range(70)] + made(3, 40)
    assert found(spark, rows, 100) == plain(rows)


def test_a_conversation_of_20000_turns(spark):
    turns = spark.range(20_000).selectExpr("20L AS conv_id", "id AS turn", "'user' AS role", "cast(id AS string) AS text")
    copy = turns.selectExpr("40L AS conv_id", "turn", "role", "text")
    nodes = trie_of(rebuilt(sequences(turns.union(copy))), 50_000)
    counts = nodes.selectExpr("count(*)", "max(depth)", "min(n_convs)", "max(saved_tokens)", "max(n_leaves)").first()
    assert tuple(counts) == (20_001, 20_000, 2, 20_000, 1)


def test_very_long_text(spark):
    long = "word " * 300_000
    rows = [(20, 0, "user", long), (40, 0, "user", long + "x"), (41, 0, "user", long), (60, 0, "user", long)]
    assert found(spark, rows, 2) == plain(rows)


def test_nulls_ties_repeats_and_turnless_conversations(spark):
    rows = [
        (20, None, None, None),
        (20, 1, "user", ""),
        (23, 1, "user", "a b"),
        (23, 1, "user", "a b"),
        (23, 1, "assistant", "c"),
        (None, 0, "user", "of no conversation"),
        (45, 0, "user", "its base is missing"),
        (47, 0, "user", "so is this one's"),
        (49, 0, "", " \t\n"),
        *[(c, 0, "user", "x") for c in range(100, 120)],
    ]
    assert found(spark, rows, 3) == found(spark, rows, 100) == plain(rows)


def test_only_turnless_conversations_make_one_leaf(spark):
    ids = [c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4]
    rows = [(c, 0, "user", "x") for c in ids]
    (root,) = found(spark, rows, 4)
    assert root == plain(rows)[0] and root[3] == len(ids) and root[5] == 1


def test_extra_columns_and_no_rows(spark):
    rows = made(9, 30)
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS shard", "2 AS base", "3 AS head", "4 AS depth", "5 AS h")
    assert found(spark, turns, 20) == plain(rows)
    assert found(spark, [], 20) == []
