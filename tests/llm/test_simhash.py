import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cabtally.llm.simhash import BLOCKS, fingerprint, linked, near_dedup, near_groups, op8_simhash_near_dedup


def plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "Éa", "c\x0b", " ", "dd", ""]), max_size=12).map(" ".join))
def test_fingerprint_is_the_plain_one(text):
    assert fingerprint(text) == plain(text)


def test_fingerprint_of_long_and_empty_texts():
    words = [f"w{i % 977}" for i in range(150_000)]
    assert fingerprint(" ".join(words)) == plain(" ".join(words))
    assert fingerprint(None) == fingerprint("") == fingerprint(" \n") == 0


def test_query_against_brute_force(spark, small, rows_of, smallest_reachable):
    got = {r.doc_id: r for r in op8_simhash_near_dedup(spark, small).collect()}
    texts = dict(rows_of("documents", "doc_id, text", small))
    assert set(got) == set(texts)
    ids = sorted(texts)
    fps = np.array([plain(texts[i]) for i in ids], np.uint64)
    assert [int(got[i].fingerprint, 16) for i in ids] == fps.tolist()
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    assert [got[i].component_id for i in ids] == smallest_reachable(near, ids)


def test_any_three_bits_are_found(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    pairs = []
    for k, one in enumerate(base.tolist()):
        bits = rng.choice(64, 3 if k % 2 else 4, replace=False)
        pairs.append((one, one ^ sum(1 << int(b) for b in bits)))
    for first, width in BLOCKS:  # all within one block, and at its ends
        pairs += [(7, 7 ^ (0b111 << first)), (9, 9 ^ (1 << first) ^ (1 << (first + width - 1)))]
    signed = sorted({x - (1 << 64) if x >> 63 else x for p in pairs for x in p})
    edges = linked(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    found = {frozenset((r.a % 2**64, r.b % 2**64)) for r in edges}
    near = {frozenset(p) for p in pairs if (p[0] ^ p[1]).bit_count() <= 3}
    lone = {p for p in near if all(len(p & q) == 0 or p == q for q in near)}
    assert lone and lone <= found
    family = {x for p in pairs[300:] for x in p}
    assert all((a ^ b).bit_count() <= 3 or {a, b} <= family for a, b in map(tuple, found))


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(None, "one two three four", 1), (5, "one two three four", 2), (3, "one two three four", 3),
            (3, "one two three four", 4), (9, None, 5), (8, "", 6), (None, "something else here now", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = near_groups(frame).collect()
    assert sorted(str(r.component_id) for r in got) == ["3", "3", "3", "3", "8", "8", "None"]
    kept = near_dedup(frame)
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "8", "None"]
