import hashlib
import json
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cabtally.llm.bpe import Bpe, _slices, decode, encode, encode_and_decode, op4_bpe_round_trip, round_trip, tokenizer_path

ODD = [
    "", "a", " ", "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>z", "<|endoftext", "  lead",
    "tabs\t\t\n\n x  ", "don't I'LL we've", "日本語テスト émojis 🙂🙂 ٣٤ ½", "a" * 3000, "  x \r\n", " " * 5000,
    "ab " * 3000 + "\n\n", "é" * 999, " x y\x00z", "A" * 70 + "B" * 70,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), digest(",".join(map(str, ids))), digest(back)


def test_odd_texts(library):
    bpe = Bpe(tokenizer_path())
    assert bpe.encode_batch(ODD) == [expected(library, t) for t in ODD]
    for text in ODD:
        assert bpe.encode(text) == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(bpe.encode(text)) == text


def test_very_long_texts_are_cut_between_words(library, monkeypatch):
    monkeypatch.setattr("cabtally.llm.bpe.PIECE", 50)
    monkeypatch.setattr("cabtally.llm.bpe.TOGETHER", 20)
    monkeypatch.setattr("cabtally.llm.bpe.KEPT_BYTES", 9000)
    bpe = Bpe(tokenizer_path())
    texts = ["one two  three\n\n\n   four's 55 !? " * 40, "x" * 300 + " y", *ODD]
    assert bpe.encode_batch(texts) == [expected(library, t) for t in texts]


def test_which_tokens_may_follow_one_another():
    own = Bpe(tokenizer_path())
    tokens = sorted(own._own)
    pick = random.Random(5)
    pairs = [(pick.choice(tokens), pick.choice(tokens)) for _ in range(3000)]
    pairs += [(t[:i], t[i:]) for t in pick.sample(tokens, 1000) for i in range(1, len(t)) if {t[:i], t[i:]} <= own._own]
    pairs += [(t, t) for t in pick.sample(tokens, 500)] + [(b"a", b"a"), (b" ", b" "), (b"=" * 4, b"=" * 8)]
    want = [own._merge(u + v) == [u, v] for u, v in pairs]
    assert len(set(want)) == 2
    assert [own._stays(u, v) for u, v in pairs] == want


def test_parts_that_are_made_late(tmp_path):
    """Merges in an order that no training gives; then the whole pair is merged."""
    letters = {c: i for i, c in enumerate("abc")}
    model = {"vocab": letters | {"abc": 3, "ab": 4}, "merges": ["ab c", "a b"]}
    (tmp_path / "late.json").write_text(json.dumps({"model": model, "added_tokens": []}))
    late = Bpe(str(tmp_path / "late.json"))
    assert not late._in_order and late.encode("abcab") == [3, 4] and late.encode("ababc") == [4, 3]


def test_words_are_learnt_with_few_merges(monkeypatch):
    """What was learnt by merging each pair of tokens anew."""
    own = Bpe(tokenizer_path())
    merged = []
    monkeypatch.setattr(own, "_merge", lambda *given: merged.append(given))
    assert own.decode(own.encode("untold unheardofness of thththeable words")) == "untold unheardofness of thththeable words"
    assert not merged


def test_query_against_the_library(spark, small, rows_of, library):
    got = {r[0]: tuple(r[1:]) for r in op4_bpe_round_trip(spark, small).collect()}
    assert got == {i: expected(library, t) for i, t in rows_of("documents", "doc_id, text", small)}


def test_nulls_repeats_and_other_columns(spark, library):
    rows = [(1, None, "z"), (1, None, "z"), (None, "hi there", "y"), (2, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(str, round_trip(frame, tokenizer_path()).collect()))
    assert len(got) == 4
    back = decode(encode(frame, tokenizer_path()), tokenizer_path()).collect()
    assert [(r.text or "", r.n_tokens) for r in back] == [(r.decoded, r.n_tokens) for r in back]


def test_batches_are_cut_by_bytes_and_lose_no_row(monkeypatch):
    monkeypatch.setattr("cabtally.llm.bpe.BATCH_BYTES", 10)
    texts = ["a" * 25, None, "", "bcd", "efg", "hij", "klm", "é" * 7, "x", None]
    batch = pa.RecordBatch.from_pydict({"n": list(range(10)), "text": pa.array(texts, pa.string())})
    cut = list(_slices(iter([batch, batch.slice(0, 0)]), 1))
    assert [t for part in cut for t in part.column(1).to_pylist()] == texts
    assert all(part.num_rows == 1 or sum(len((t or "").encode()) for t in part.column(1).to_pylist()) <= 10 for part in cut)


def test_ids_are_decoded_in_the_same_task(spark, library):
    rows = [(1, None, "z"), (1, None, "z"), (None, "hi there", "y"), (2, "", None), (3, "long é " * 50_000, "w")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    found = encode_and_decode(frame, tokenizer_path())
    assert found.columns == ["doc_id", "token_ids", "decoded_sha256"]
    want = [(i, library.encode(t or "", add_special_tokens=False).ids, expected(library, t)[2]) for i, t, _ in rows]
    assert sorted(map(str, found.collect())) == sorted(str(row) for row in spark.createDataFrame(want, found.schema).collect())
    assert encode_and_decode(frame.limit(0), tokenizer_path()).collect() == []
