"""Token counts by a separator scan over flat token files.

A flat token file is nothing but token ids, two bytes each, big-endian, with an
end-of-document id after each document: no index, no lengths. Files are scanned in blocks:
in each the separators are found by one vectorised comparison, and what crosses a block's
boundary is put together by a prefix scan over the blocks: the position of the last
separator before a block, and how many there are.

Files are written by Spark's text writer, so through any file system it reaches. A text
record is a document's bytes up to the last one of its separator; the line separator is
that last byte, "P".
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabtally.llm.bpe import tokenizer_path
from cabtally.llm.common import numbered, table
from cabtally.sources.storage import scratch_folder

RANKS = "byte_bpe_50k.tiktoken"
#: End of document: the id the vocabulary leaves free. Its bytes are C4 50.
SEPARATOR = 50256
WIDTH = 2
#: Tokens of a block, and documents of a file.
BLOCK = 1 << 16
DOCUMENTS_PER_FILE = 4000
#: Code points that the encoder gets at once, of documents together.
TOGETHER = 1 << 22


@cache
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_token_files(documents: DataFrame, folder: str, path: str, per_file: int = DOCUMENTS_PER_FILE) -> None:
    """Flat token files of the column ``text``, in the order of the rows: partition p is in
    the files part-p-*, ``per_file`` documents each. Null texts are empty documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for text in batch.column(0):
                ids = encoder(path).encode_ordinary(text.as_py() or "")
                raw.append(np.array(ids, ">u2").tobytes() + b"\xc4")
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], ["raw"])

    documents.select("text").mapInArrow(run, "raw binary").select(
        F.col("raw").cast("string").alias("value")
    ).write.option("lineSep", "P").option("compression", "none").option("maxRecordsPerFile", per_file).text(folder)


def separators(spark: SparkSession, folder: str, block: int = BLOCK) -> DataFrame:
    """``(file, block, start, size, places)``: the blocks of the files, where each begins,
    how many tokens it has, and at which of them the separators are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = np.frombuffer(content.as_buffer(), ">u2")
                name = path.rpartition("/")[2]
                starts = range(0, len(tokens), block)
                places = [np.flatnonzero(tokens[s : s + block] == SEPARATOR).astype(np.int32) for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(starts), pa.string()),
                        pa.array(range(len(starts)), pa.int32()),
                        pa.array(list(starts), pa.int64()),
                        pa.array([min(block, len(tokens) - s) for s in starts], pa.int32()),
                        pa.array(places, pa.list_(pa.int32())),
                    ],
                    ["file", "block", "start", "size", "places"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(
        run, "file string, block int, start long, size int, places array<int>"
    )


def document_lengths(blocks: DataFrame) -> DataFrame:
    """``(file, ordinal, n_tokens, closed)``: each document of each file in order. Tokens
    after a file's last separator are a document that is not closed."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.col("start") + F.element_at("places", -1)
    some = F.size("places") > 0
    scanned = blocks.select(
        "file", "block", "start", "size", "places",
        F.coalesce(F.max(F.when(some, last)).over(before), F.lit(-1)).alias("previous"),
        F.coalesce(F.sum(F.size("places")).over(before), F.lit(0)).alias("ahead"),
        (F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull()).alias("final"),
    )
    ends = F.transform("places", lambda p: F.col("start") + p)
    begins = F.concat(F.array(F.col("previous")), ends)
    lengths = F.zip_with(ends, F.slice(begins, 1, F.size("places")), lambda e, b: e - b - 1)
    closed = scanned.where(some).select(
        "file", "ahead", F.posexplode(lengths).alias("k", "n_tokens")
    ).select("file", (F.col("ahead") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    rest = F.col("start") + F.col("size") - F.element_at(begins, -1) - 1
    tail = scanned.where("final").select(
        "file", (F.col("ahead") + F.size("places")).alias("ordinal"), rest.alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.union(tail.where("n_tokens > 0"))


def token_counts(documents: DataFrame, path: str, per_file: int = DOCUMENTS_PER_FILE, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_tokens)`` of each of the ``documents``, from the flat files they are
    written to. They are read twice and have to come in the same order each time, as those
    of a file scan do: the k-th document of a file is the k-th row that went into it. Null
    and empty texts have no tokens; null and repeated ids are rows like any other."""
    spark = documents.sparkSession
    folder = f"{scratch_folder(spark, 'tokens')}/files"
    rows = numbered(documents.select("doc_id"), "row")  # before they are written: fixes the splits
    write_token_files(documents, folder, path, per_file)
    lengths = document_lengths(separators(spark, folder, block))
    part = F.regexp_extract("file", r"^part-(\d+)-.*-c(\d+)", 1).cast("long")
    number = F.regexp_extract("file", r"^part-(\d+)-.*-c(\d+)", 2).cast("long")
    # As monotonically_increasing_id numbers the rows of a partition.
    row = F.shiftleft(part, 33) + number * per_file + F.col("ordinal")
    return rows.join(lengths.select(row.alias("row"), "n_tokens"), "row").select("doc_id", "n_tokens")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path(RANKS))
