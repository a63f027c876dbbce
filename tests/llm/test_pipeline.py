"""The pipeline stage by stage against brute force over the same tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_simhash import plain
from tokenizers import Tokenizer

import corpus_pipeline
from cabtally.llm.bpe import tokenizer_path
from cabtally.llm.common import stored
from cabtally.llm.toxicity import op3_toxicity


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small), f"test-{name}")
        found.append(docs)
    return found


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_keep_the_columns_of_documents(stages):
    for frame in stages[1:-1]:
        assert frame.dtypes == stages[0].dtypes


def test_toxic_documents_go(spark, small, stages):
    toxic = {r.doc_id for r in op3_toxicity(spark, small).collect() if r.predicted}
    assert ids(stages[1]) == [i for i in ids(stages[0]) if i not in toxic]
    assert len(ids(stages[1])) > 0.8 * len(ids(stages[0]))


def test_copies_go(stages):
    groups = defaultdict(list)
    for r in stages[1].collect():
        groups["".join(c for c in r.text if c not in " \t\n\x0b\f\r")].append((-len(r.text), r.doc_id))
    assert ids(stages[2]) == sorted(min(g)[1] for g in groups.values())


def test_near_copies_go(stages, smallest_reachable):
    rows = sorted((r.doc_id, plain(r.text)) for r in stages[2].collect())
    fps = np.array([f for _, f in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    assert ids(stages[3]) == sorted(set(smallest_reachable(near, [i for i, _ in rows])))


def test_sources_are_mixed(stages):
    size = {r.doc_id: len(r.text.split()) for r in stages[3].collect()}
    times = Counter(ids(stages[4]))
    assert set(times) <= set(size) and max(times.values()) == 2
    total = sum(size[i] * n for i, n in times.items())
    assert abs(total - 1.5 * sum(size.values())) <= 20 * max(size.values())


def test_texts_are_encoded(stages):
    library = Tokenizer.from_file(tokenizer_path())
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    assert ids(stages[5]) == ids(stages[4])
    for r in stages[5].collect():
        assert r.token_ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.token_ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_toxicity_gives_python_few_documents_at_once(spark, small, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, most = spark.conf.get(key), spark.sparkContext.accumulator(0)

    def clean(docs, labels):
        def run(batches):
            for batch in batches:
                most.add(batch.num_rows > corpus_pipeline.ROWS)
                yield batch

        return docs.mapInArrow(run, docs.schema)

    monkeypatch.setattr(corpus_pipeline, "clean_documents", clean)
    docs = spark.range(3 * corpus_pipeline.ROWS, numPartitions=1).selectExpr("id AS doc_id", "'x' AS text")
    assert corpus_pipeline.drop_toxic(spark, docs, small).count() == 3 * corpus_pipeline.ROWS
    assert most.value == 0 and spark.conf.get(key) == before


def test_run_is_the_stages_one_after_the_other(spark, small, stages):
    got = corpus_pipeline.run(spark, small)
    assert got.columns == stages[5].columns
    assert got.exceptAll(stages[5]).isEmpty() and stages[5].exceptAll(got).isEmpty()


CLASHING = ["row", "_row", "shard", "_shard", "place", "_place", "score", "_score", "level", "name", "fp", "size", "token_ids"]


def odd(spark):
    """Nulls, empty texts, repeated rows and a very long text, with clashing columns."""
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "you are an idiot", "en", "a", 16)]
    rows += [(4, "same words here and there", "en", "b", 25)] * 3 + [(5, "word " * 200_000, None, "b", 1_000_000)]
    rows += [(6, "same\nwords here and there", "de", None, 25), (None, "of no id but with words", "de", "b", 24)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return stored(frame.selectExpr("*", *[f"7 AS {name}" for name in CLASHING]), "odd")


def test_stages_take_odd_rows_and_keep_clashing_columns(spark, small):
    docs = odd(spark)
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stored(stage(spark, docs, small), f"odd-{name}")
        assert found.dtypes == docs.dtypes
        assert found.select(*CLASHING).distinct().collect() == [tuple([7] * len(CLASHING))]
        kept.append(Counter(str(r.doc_id) for r in found.collect()))
        docs = found
    assert kept[0] == {"None": 2, "1": 1, "2": 1, "3": 1, "4": 3, "5": 1, "6": 1}
    assert kept[1] == {"1": 1, "3": 1, "4": 1, "5": 1, "None": 1}
    assert kept[2] == kept[1]
    assert set(kept[3]) <= {"3", "4", "5", "None"} and max(kept[3].values()) <= 2
    last = corpus_pipeline.STAGES[-1][1](spark, odd(spark), small)
    tokens = {(r.doc_id, r.n_tokens) for r in last.collect()}
    assert {(1, 0), (2, 0), (None, 0)} <= tokens and len(last.columns) == 6 and last.count() == 10


def test_stages_take_empty_tables(spark, small):
    docs = odd(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small), f"none-{name}")
        assert docs.count() == 0


def test_documents_without_ids_are_drawn_at_random(spark):
    from cabtally.llm.mixing import mix

    rows = [(None, "w " * (1 + i % 50), "en", "a", 0) for i in range(2000)]
    frame = stored(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "unnamed")
    times = Counter(len(r.text.split()) for r in mix(frame).collect())
    short, long = (sum(times[n] for n in part) for part in (range(1, 26), range(26, 51)))
    assert 0.85 < short / long < 1.15
