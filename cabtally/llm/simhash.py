"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints with at most 3 differing bits meet in the middle of the path between
them, so each emits the variants within half the radius and equal variants name a
candidate pair. An odd radius has no whole half. Therefore a fingerprint of 64 bits is cut
into three blocks, and each block in turn is left out: of 3 differing bits at least one
lies in some block, and without that block at most 2 are left, whose half is 1. (With 2
or fewer differing bits any block does.) A fingerprint so emits 3 times the ball of
radius 1 over some 43 bits, 131 variants, in place of the 2081 that a ball of radius 2
over 64 bits has, and a variant still has 43 bits, so random fingerprints rarely collide.

Copies are one fingerprint before anything is emitted. Candidates are never written out as
pairs: a task reads the fingerprints of a variant in sorted order, verifies them by
counting bits, and emits at most one edge per member, which keeps what is connected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.llm.common import components, free_name, numbered, stored, table

SHINGLE = 3
SEED = 42
RADIUS = 3
#: First bit and width of the blocks that are left out in turn.
BLOCKS = ((0, 21), (21, 21), (42, 22))

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Words of a text that are hashed at once; bounds the memory of very long texts.
_CHUNK = 1 << 16
#: Members of a variant that are compared with all others at once.
_ROWS = 256


def fingerprint(text: str | bytes | None, words: int = SHINGLE) -> int:
    """SimHash of the XXH64 values of all word shingles, repeats included."""
    if not text:
        return 0
    raw = (text.encode() if isinstance(text, str) else text).translate(_LOWER)
    found = _WORDS.findall(raw)
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(found))
    starts, ends = starts[: len(found) - width + 1], ends[width - 1 :]
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        cut = zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], seed) for s, e in cut], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * ones > len(starts))
    return sum(1 << int(b) for b in set_bits)


def fingerprints(documents: DataFrame) -> DataFrame:
    """``(row, doc_id, fp)`` of each of the ``documents`` ``(row, doc_id, text)``; fp is the
    fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            values = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values.view(np.int64))],
                ["row", "doc_id", "fp"],
            )

    kinds = dict(documents.dtypes)
    return documents.select("row", "doc_id", "text").mapInArrow(
        run, f"row {kinds['row']}, doc_id {kinds['doc_id']}, fp long"
    )


def _mask(first: int, width: int) -> int:
    value = ((1 << width) - 1) << first
    return value - (1 << 64) if value >= 1 << 63 else value


def variants(fps: DataFrame) -> DataFrame:
    """``(variant, fp)``: for each block the fingerprint without it and all that differ
    from that in one bit. The lowest bits of the block left out tell the blocks apart."""
    every = []
    for number, (first, width) in enumerate(BLOCKS):
        rest = F.col("fp").bitwiseAND(F.lit(~_mask(first, width))).bitwiseOR(F.lit(number << first))
        bits = [b for b in range(64) if not first <= b < first + width]
        every += [rest, *(rest.bitwiseXOR(F.lit(_mask(b, 1))) for b in bits)]
    return fps.select(F.explode(F.array(*every)).alias("variant"), "fp")


def _labels(fps: np.ndarray) -> np.ndarray:
    """For each fingerprint the smallest one that links within RADIUS connect it to."""
    label, size = fps.copy(), len(fps)
    while True:
        before = label.copy()
        for at in range(0, size, _ROWS):
            near = np.bitwise_count(fps[at : at + _ROWS, None] ^ fps[None, :]) <= RADIUS
            label[at : at + _ROWS] = np.where(near, label[None, :], np.uint64(2**64 - 1)).min(axis=1)
        if (label == before).all():
            return label


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified edges between the fingerprints of each variant; input is sorted by both."""

    def of(variant: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], variant[1:] != variant[:-1])))
        sizes = np.diff(np.append(starts, len(variant)))
        a, b = [], []
        two = starts[sizes == 2]  # nearly all that meet at all are two
        near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= RADIUS
        a.append(fp[two + 1][near])
        b.append(fp[two][near])
        for at, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            own = fp[at : at + size]
            label = _labels(own)
            other = label != own
            a.append(own[other])
            b.append(label[other])
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))], ["a", "b"]
        )

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        variant = batch.column(0).to_numpy()
        fp = batch.column(1).to_numpy().view(np.uint64)
        if not len(variant):
            continue
        cut = int(np.searchsorted(variant, variant[-1]))  # the last variant may go on
        if cut or (held and held[-1][0][-1] != variant[0]):
            whole = [*held, (variant[:cut], fp[:cut])]
            yield of(np.concatenate([v for v, _ in whole]), np.concatenate([f for _, f in whole]))
            held = []
        held.append((variant[cut:], fp[cut:]))
    if held:
        yield of(np.concatenate([v for v, _ in held]), np.concatenate([f for _, f in held]))


def linked(fps: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints ``fp`` linked within RADIUS:
    the same components as all links have, but not each link. Where several share a
    variant, an edge can join two that are linked only through others there."""
    # A few bytes become many, so all cores should make them.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = fps.repartition(parts, "fp")
    met = variants(spread).repartition("variant").sortWithinPartitions("variant", "fp")
    return met.mapInArrow(_edges, "a long, b long").distinct()


def near_groups(documents: DataFrame, row: str | None = None) -> DataFrame:
    """One row per document: ``row, doc_id, fingerprint, component_id, stays``.

    Needs ``doc_id`` and ``text``; other columns are not read, but for the one that ``row``
    names, if any, as what tells the rows apart. Texts without words, null ones too, have fingerprint zero.
    ``component_id`` is the smallest ``doc_id`` of the component, null only if all are;
    ``stays`` marks one row of each component, the one with that id. Repeated rows are in
    one component. An empty table gives an empty result.
    """
    if row is None:
        rows = numbered(documents.select("doc_id", "text"), "row")
    else:
        rows = documents.select(F.col(row).alias("row"), "doc_id", "text")
    members = stored(fingerprints(rows), "fingerprints")
    distinct = members.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("first")
    )
    roots = components(linked(distinct.select("fp")), "near-links").select(
        F.col("node").alias("fp"), "root"
    )
    classes = distinct.join(roots, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    best = classes.groupBy("root").agg(F.min("first").alias("best"))
    of_fp = classes.join(best, "root").select(
        "fp", F.col("best.doc_id").alias("component_id"), F.col("best.row").alias("best_row")
    )
    return members.join(of_fp, "fp").select(
        "row",
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        (F.col("row") == F.col("best_row")).alias("stays"),
    )


def near_dedup(documents: DataFrame) -> DataFrame:
    """The ``documents`` with one of each component left, all their columns. They are read
    twice and have to come in the same order each time, as those of a file scan do."""
    row = free_name(documents, "row")
    rows = numbered(documents, row)
    stays = near_groups(rows, row).where("stays").select(F.col("row").alias(row))
    return rows.join(stays, row, "left_semi").drop(row)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents", "doc_id", "text")).drop("row")
