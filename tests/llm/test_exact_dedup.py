from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cabtally.llm.common import components, numbered
from cabtally.llm.exact_dedup import exact_dedup, exact_groups, identities

TEXTS = ["a b c" * 300, "abc" * 300, "abc" * 300 + "d", None, "", " \n\t", "x", "x", "é" * 50, "é" * 49 + "e", " x"]


def normal(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\f\r")


@pytest.mark.parametrize("bits", [64, 2])
@pytest.mark.parametrize("block", [3, 16, 4096])
def test_names_stand_for_texts_also_where_hashes_collide(spark, bits, block):
    rows = numbered(spark.createDataFrame([(t,) for t in TEXTS], "text string"), "row")
    text_of = {r.row: normal(r.text) for r in rows.collect()}
    found = defaultdict(set)
    for r in identities(rows, block, bits).collect():
        found[r.level, r.name].add(text_of[r.row])
    assert all(len(texts) == 1 for texts in found.values())
    assert len(found) == len(set(text_of.values()))


def test_which_row_stays(spark):
    rows = [(5, "a b"), (3, "ab"), (4, "a b"), (None, "a b"), (7, None), (7, None), (None, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_groups(frame).collect()
    of_ab = [r for r in got if r.group_size == 4]
    assert {r.keep_id for r in of_ab} == {4} and [r.doc_id for r in of_ab if r.kept] == [4]
    assert sum(r.kept for r in got if r.doc_id == 7) == 1
    assert [r.kept for r in got if r.group_size == 1] == [True]


def test_dedup_keeps_all_columns(spark):
    frame = spark.createDataFrame(
        [(1, "a", "n", 9), (2, " a", "m", 8), (3, "b", None, 7)], "doc_id long, text string, name string, pos int"
    )
    got = exact_dedup(frame)
    assert got.columns == frame.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 3]


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, i) for i in range(1001, 1200)]
    ring = [(2000 + i, 2000 + (i + 1) % 7) for i in range(7)]
    edges = spark.createDataFrame([*path, *star, *ring, (5, 5), (1, 0)], "a long, b long").orderBy(F.rand(3))
    got = {r.node: r.root for r in components(edges).collect()}
    want = {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1200)} | {i: 2000 for i in range(2000, 2007)}
    assert got == want
    assert components(edges.limit(0)).collect() == []
