"""The divergence audit against Python's own integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cabtally.llm import divergence as module
from cabtally.llm.divergence import Slots, _hash, _share, divergence, perfect_hash

SCHEMA = "lang string, source string, text string"


def plain(rows):
    """The audit's rows as a set, from (lang, source, text)."""
    rows = [tuple(v or "" for v in row) for row in rows]
    words = lambda text: [
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
        for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
    ]
    result = set()
    for lang in {row[0] for row in rows}:
        documents, counts = Counter(), defaultdict(Counter)
        for own, source, text in rows:
            if own == lang:
                documents.update(set(words(text)))
                counts[source].update(words(text))
        kept = [t for t, n in documents.items() if n >= 3]
        share = lambda n, total: 1 + 10**9 * (n + 1) // (total + len(kept))
        total = {s: sum(c[t] for t in kept) for s, c in counts.items()}
        p = {s: {t: share(c[t], total[s]) for t in kept} for s, c in counts.items()}
        every = sum(counts.values(), Counter())
        q = {t: share(every[t], sum(total.values())) for t in kept}
        far = lambda a, b: (a - b) ** 2 // b
        for source in counts:
            pairs = [(-sum(far(p[source][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != source]
            terms = [(-far(p[source][t], q[t]), t.encode()) for t in kept if counts[source][t] and p[source][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:200])):
                result |= {(lang, source, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)}
    return result


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    collected = divergence(frame, **options).collect()
    result = {tuple(row) for row in collected}
    assert len(result) == len(collected)
    return result


def made(seed, n=300, vocabulary=400):
    rng = random.Random(seed)
    names = ["w" + "abcdefghij"[i % 10] * (i // 10 + 1) for i in range(vocabulary)]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(4)}"
        of = names[: vocabulary // 2] if source == "s1" else names
        text = " ".join(rng.choice(of)[: rng.randrange(1, 12)] for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "de"]), source, text.title() if i % 5 == 0 else text))
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_terms": 64, "broadcast_bytes": 1500}])
def test_equals_python(spark, options):
    rows = made(len(options))
    assert found(spark, rows, **options) == plain(rows)


def test_small_memory_bounds_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(module, "COUNTED_WORDS", 50)
    monkeypatch.setattr(module, "SLOT_BYTES", 100)
    monkeypatch.setattr(module, "SLOT_LIMIT", 60)
    rows = made(7)
    assert found(spark, rows) == plain(rows)


def test_nulls_empty_texts_repeats_and_groups_without_terms(spark):
    rows = [
        (None, None, "a a b"),
        ("", "x", "a b"),
        (None, "x", "A c"),
        ("", "y", None),
        ("fr", "only", "été ÉTÉ"),
        ("fr", "only", "été"),
        ("fr", "only", "été"),
        ("fr", "none", ""),
        ("de", "p", "x1y z"),
        ("de", "q", "z"),
    ]
    assert found(spark, rows) == plain(rows)


def test_very_long_texts_ties_and_more_terms_than_ranks(spark):
    names = ["t" + "".join("abcdefghij"[int(d)] for d in str(i)) for i in range(300)]
    rows = [("en", "long", " ".join(names) * 3 + " x" * 400_000), ("en", "b", " ".join(names)), ("en", "c", " ".join(names) + " y")]
    rows += [("en", "d", "x é"), ("en", "d", "x é"), ("en", "long", "é x")]
    assert found(spark, rows) == plain(rows)


def test_extra_columns_and_no_rows(spark):
    rows = made(11, 60)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS shard", "2 AS n", "3 AS term", "4 AS slot", "5 AS terms")
    assert found(spark, frame) == plain(rows)
    assert found(spark, []) == set()


@pytest.mark.parametrize("n", [1, 2, 3, 50, 3000])
def test_perfect_hash_is_one_to_one(n):
    rng = np.random.default_rng(n)
    _, slots = perfect_hash(rng.integers(0, 2**63, n).astype(np.uint64))
    assert sorted(slots.tolist()) == list(range(n))


def _rows(terms, shards=1):
    import pyarrow as pa

    return [
        module._shard_of(pa.table({"lang": ["en"] * len(own), "shard": [s] * len(own), "term": pa.array(own, pa.binary())})).to_pylist()[0]
        for s in range(shards)
        if (own := [t for t in terms if np.int64(np.uint64(_hash(t)).view(np.int64)) % shards == s])
    ]


def test_words_that_are_no_terms_have_no_slot():
    terms = [f"k{i}".encode() for i in range(500)]
    slots = Slots(_rows(terms, 4), 4)
    assert sorted(slots.find(terms).tolist()) == list(range(500))
    assert (slots.find([f"n{i}".encode() for i in range(500)]) == -1).all()


def test_terms_of_equal_hashes_have_slots_of_their_own(monkeypatch):
    monkeypatch.setattr(module, "_hash", lambda term: len(term))
    terms = [b"a", b"b", b"cc", b"dd", b"ee", b"fff"]
    slots = Slots(_rows(terms), 1)
    assert sorted(slots.find(terms).tolist()) == list(range(6))
    assert slots.find([b"x", b"zz"]).tolist() == [-1, -1]


def test_shares_are_exact_for_large_counts():
    for count, total in ((0, 1), (10**15, 3 * 10**15 + 7), (9 * 10**14, 9 * 10**15), (5, 7)):
        assert _share(np.array([count]), np.int64(total)).tolist() == [1 + 10**9 * (count + 1) // total]
