import pytest

from cabtally.llm.bpe import tokenizer_path
from cabtally.llm.common import numbered
from cabtally.llm.exact_dedup import exact_dedup
from cabtally.llm.token_counts import RANKS, token_counts


@pytest.fixture
def cores(spark):
    """Sets the number of cores Spark counts, as executors that come and go do."""
    conf = spark.sparkContext._jsc.sc().conf()
    yield lambda n: conf.set("spark.default.parallelism", str(n))
    conf.remove("spark.default.parallelism")


@pytest.fixture
def documents(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.files.openCostInBytes", "1k")
    texts = session.range(20_000).selectExpr("id AS doc_id", "concat(id % 15000, ' ', uuid()) AS text")
    texts.coalesce(1).write.option("parquet.block.size", "65536").parquet(f"{tmp_path}/documents")
    return session.read.parquet(f"{tmp_path}/documents")


def test_rows_keep_their_numbers_when_cores_come_and_go(documents, cores):
    def read(n):
        cores(n)
        again = documents.sparkSession.read.parquet(*documents.inputFiles())
        return {r.row: r.doc_id for r in numbered(again, "row").select("row", "doc_id").collect()}

    first = read(8)
    assert len(first) == 20_000 and read(2) == first and read(16) == first


def test_kept_rows_are_found_again(documents, cores):
    cores(8)
    kept = exact_dedup(documents)
    cores(2)
    assert kept.count() == 20_000


def test_counts_meet_their_documents(documents, cores, monkeypatch):
    import cabtally.llm.token_counts as module

    write = module.write_token_files
    monkeypatch.setattr(module, "write_token_files", lambda *a: (write(*a), cores(2)))
    cores(8)
    assert token_counts(documents, tokenizer_path(RANKS)).count() == 20_000
