"""Near-duplicate embeddings by collision-counting projections.

Vectors are projected onto many random directions. Two near vectors lie near each other on
nearly all of them: within a window centred at the one, the other is found, and the number
of directions on which that happens, counted per pair, tells near pairs from others. The
count that a pair has to reach is calibrated so that a pair at the cosine threshold
reaches it with probability ``COUNT_RECALL``; pairs that do are verified in double
precision.

Counting for all pairs would be quadratic. So a pair is counted where it meets: vectors are
sorted in several tables by cells. A cell says on which of some directions of the table's own
a vector lies farthest out, and on which side; near vectors agree in that, whatever their
length. With more vectors there are more cells, such that about ``MEMBERS`` share one, and
more tables, such that a pair at the threshold meets in some table with probability
``MEET_RECALL``; nearer pairs have more. Tables grow with about n ** 0.16.

Equal vectors are one, with their number. What a table sorts is no vector but its projections,
a byte each. Pairs never leave a task: a table's cell is cut into tiles of bounded size, a tile
counts the windows of its vectors' pairs, each pair in the first table in which it meets, and
tells who has a pair that reaches the count. Only these vectors are sent to their tiles
themselves, to be verified; a tile returns per vector its number of links and one edge that
keeps components together. A few tables are sorted at once, and their files go before the next.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.llm.common import components, numbered, shuffles_freed, stored, table

COSINE = 0.9
MEET_RECALL = 0.985
COUNT_RECALL = 0.998
#: Share of pairs at the threshold that their distance in the projections may cost.
DISTANCE_LOSS = 1e-4
SEED = 20240
#: Directions of the count, and half the window around a query.
DIRECTIONS = 32
WINDOW = 1.0
#: A projection's code per standard deviation, and the largest, so that a byte holds differences.
CODE = 32
FARTHEST = 111
#: Vectors of a cell, about; directions that a part of a cell is chosen from, at most.
MEMBERS = 500
CHOICE = 128
#: Times as many pairs as expected that make cells finer.
CROWDED = 8
#: Members of a tile's side, and of it that are compared at once.
TILE = 4000
ROWS = 128
#: Tables that are sorted at once.
TABLES = 4


@lru_cache
def _same_direction(cosine: float, directions: int) -> float:
    """Probability that two vectors lie farthest out on the same one of so many normal
    directions, on the same side: an integral over the two projections on that one."""
    step = 0.02
    x = np.arange(step / 2, 7, step)
    a, b = x[:, None], x[None, :]

    def density(b: np.ndarray) -> np.ndarray:
        spread = 1 - cosine * cosine
        return np.exp(-(a * a - 2 * cosine * a * b + b * b) / (2 * spread)) / (2 * math.pi * math.sqrt(spread)) * step**2

    same, folded = density(b), 2 * (density(b) + density(-b))
    corner = np.pad(folded.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    within = (corner[1:, 1:] + corner[:-1, 1:] + corner[1:, :-1] + corner[:-1, :-1]) / 4  # on another direction both lie nearer
    return float(2 * directions * (same * within ** (directions - 1)).sum())


def shape(vectors: int, cosine: float = COSINE, members: float = MEMBERS) -> tuple[int, int, int]:
    """Parts of a cell, tables, and directions that a part is chosen from, for so many vectors;
    no directions if one cell will do."""
    cells = vectors / members
    if cells < 2:
        return 1, 1, 0
    parts = max(1, math.ceil(math.log(cells) / math.log(2 * CHOICE)))
    directions = math.ceil(cells ** (1 / parts) / 2)
    tables = math.ceil(math.log(1 - MEET_RECALL) / math.log(1 - _same_direction(cosine, directions) ** parts))
    return parts, tables, directions


def least_count(cosine: float = COSINE) -> int:
    """Collisions that a pair at the threshold reaches with probability COUNT_RECALL."""
    p = 2 * NormalDist().cdf(WINDOW / math.sqrt(2 - 2 * cosine)) - 1
    total, count = 0.0, DIRECTIONS + 1
    while total < COUNT_RECALL:
        count -= 1
        total += math.comb(DIRECTIONS, count) * p**count * (1 - p) ** (DIRECTIONS - count)
    return count


def _farthest(cosine: float) -> float:
    """Squared distance of the codes of a pair at the threshold, but for DISTANCE_LOSS: a chi
    square quantile by Wilson and Hilferty."""
    part = 2 / (9 * DIRECTIONS)
    quantile = DIRECTIONS * (1 - part + NormalDist().inv_cdf(1 - DISTANCE_LOSS) * math.sqrt(part)) ** 3
    return 1.01 * quantile * (2 - 2 * cosine) * CODE**2  # codes are rounded


@lru_cache(8)
def _directions(size: int, number: int, part: int, kind: type = np.float64) -> np.ndarray:
    return np.random.default_rng((SEED, part, size)).standard_normal((size, number), kind)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrices(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors of each length."""
    lengths = lists.value_lengths().to_numpy()
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        values = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, values.astype(np.float64).reshape(-1, size)


def _fixed(binary: pa.BinaryArray) -> np.ndarray:
    """Bytes of each row, where all rows have as many."""
    start, stop = (int(x) for x in np.frombuffer(binary.buffers()[1], np.int32)[[binary.offset, binary.offset + len(binary)]])
    return np.frombuffer(binary.buffers()[2], np.uint8)[start:stop].reshape(len(binary), -1)


def _usable() -> Column:
    """Whether the embedding has a direction."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def digests(vectors: DataFrame) -> DataFrame:
    """``(row, vec_id, digest)`` of usable vectors ``(row, vec_id, embedding)``; equal ones
    have equal digests of 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [b""] * batch.num_rows
            for at, values in _matrices(batch.column(2)):
                for i, value in zip(at.tolist(), values + 0.0, strict=True):  # no negative zero
                    found[i] = hashlib.blake2b(value.tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found, pa.binary())], ["row", "vec_id", "digest"]
            )

    kind = dict(vectors.dtypes)["vec_id"]
    return vectors.select("row", "vec_id", "embedding").mapInArrow(run, f"row long, vec_id {kind}, digest binary")


def _keyed(vectors: DataFrame, parts: int, tables: int, directions: int) -> DataFrame:
    """``(row, codes, cells)``: a usable vector's codes on the directions of the count, a byte
    each, and its cell in each table."""

    def cells_of(unit: np.ndarray) -> np.ndarray:
        size, number = unit.shape[1], parts * tables
        if not directions:
            return np.full((len(unit), tables), size, np.int32)
        side = np.empty((len(unit), number), np.int64)
        own = _directions(size, number * directions, 1, np.float32)
        unit = unit.astype(np.float32)
        together = max(1, (1 << 21) // own.shape[1])
        for at in range(0, len(unit), together):
            place = (unit[at : at + together] @ own).reshape(-1, number, directions)
            best = np.abs(place).argmax(axis=2)
            far = np.take_along_axis(place, best[:, :, None], axis=2)[:, :, 0]
            side[at : at + together] = 2 * best + (far > 0)
        mix = np.random.default_rng((SEED, 2, size)).integers(1, 1 << 62, number) | 1
        mixed = (side * mix).reshape(len(unit), tables, parts).sum(axis=2)
        return ((mixed ^ (mixed >> 29)) * 0x1B873593 >> 31).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.empty((batch.num_rows, DIRECTIONS), np.uint8)
            cells = np.empty((batch.num_rows, tables), np.int32)
            for at, values in _matrices(batch.column(1)):
                unit = _unit(values)
                far = np.round(unit @ _directions(unit.shape[1], DIRECTIONS, 3) * CODE)
                codes[at] = far.clip(-FARTHEST, FARTHEST).astype(np.int8).view(np.uint8)
                cells[at] = cells_of(unit)
            raw = pa.array([x.tobytes() for x in codes], pa.binary())
            lists = pa.ListArray.from_arrays(np.arange(0, cells.size + 1, tables, np.int32), pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), raw, lists], ["row", "codes", "cells"])

    return vectors.select("row", "embedding").mapInArrow(run, "row long, codes binary, cells array<int>")


def _sides(tile: pa.RecordBatch) -> tuple[bool, np.ndarray]:
    """Whether a tile has two sides, which are compared with each other only, else all with all;
    and who is on the first."""
    low, high = divmod(tile.column("tile")[0].as_py(), 1 << 32)
    return low != high, tile.column("side").to_numpy() == low


def _compared(across: bool, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    number = np.arange(len(first))
    return (number[first], number[~first]) if across else (number, number)


def _earlier(tile: pa.RecordBatch) -> np.ndarray:
    """Cells of a tile's members in the tables before its own."""
    return tile.column("cells").flatten().to_numpy().reshape(tile.num_rows, -1)


def _fresh(cells: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs do not share a cell of an earlier table, where they would be counted."""
    return ~(cells[a] == cells[b]).any(axis=1)


def _counted(across: bool, side: np.ndarray, codes: np.ndarray, cells: np.ndarray, cosine: float) -> np.ndarray:
    """Which members of a tile have a pair that reaches the count and has met nowhere before."""
    first, rest = _compared(across, side)
    wanted = np.zeros(len(side), bool)
    least, width, farthest = least_count(cosine), round(WINDOW * CODE) + 1, _farthest(cosine)
    mine_of = np.ascontiguousarray(codes[first].T) + np.uint8(width)  # bytes wrap around
    rest_of = np.ascontiguousarray(codes[rest].T)
    for at in range(0, len(first), ROWS):
        begin = 0 if across else at
        shape_of = (min(ROWS, len(first) - at), len(rest) - begin)
        count, apart, hit = np.zeros(shape_of, np.uint8), np.empty(shape_of, np.uint8), np.empty(shape_of, bool)
        for k in range(DIRECTIONS):
            np.subtract(mine_of[k, at : at + ROWS, None], rest_of[k, None, begin:], out=apart)
            np.less_equal(apart, 2 * width, out=hit)
            np.add(count, hit.view(np.uint8), out=count)
        found = np.flatnonzero(count >= least)
        for cut in range(0, len(found), 1 << 16):
            i, j = np.divmod(found[cut : cut + (1 << 16)], shape_of[1])
            a, b = first[at + i], rest[begin + j]
            if not across:
                a, b = a[a < b], b[a < b]
            apart_by = codes[a].view(np.int8).astype(np.int32) - codes[b].view(np.int8)
            near = (apart_by * apart_by).sum(axis=1) <= farthest
            a, b = a[near], b[near]
            fresh = _fresh(cells, a, b)
            wanted[a[fresh]] = wanted[b[fresh]] = True
    return wanted


def _linked(across: bool, side: np.ndarray, node: np.ndarray, size: np.ndarray, values: np.ndarray, cells: np.ndarray, cosine: float):
    """Links of a tile's vectors, all of one length, as ``(node, links, edge)``."""
    first, rest = _compared(across, side)
    links, label = np.zeros(len(node), np.int64), node.copy()
    unit, near_of = _unit(values), []
    for at in range(0, len(first), ROWS):
        begin = 0 if across else at
        mine, others = first[at : at + ROWS], rest[begin:]
        found = np.flatnonzero(unit[mine] @ unit[others].T >= cosine - 1e-9)
        for cut in range(0, len(found), 1 << 16):
            i, j = np.divmod(found[cut : cut + (1 << 16)], len(others))
            a, b = mine[i], others[j]
            if not across:
                a, b = a[a < b], b[a < b]
            near = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
            a, b = a[near], b[near]
            fresh = _fresh(cells, a, b)
            a, b = a[fresh], b[fresh]
            np.add.at(links, a, size[b])
            np.add.at(links, b, size[a])
            near_of.append((a, b))
    if near_of:
        a, b = (np.concatenate(x) for x in zip(*near_of, strict=True))
        while len(a):
            before = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            if (label == before).all():
                break
    linked = links > 0
    return node[linked], links[linked], label[linked]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are sorted by ``place, tile``, the members of a tile together."""

    def whole(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sum(x.num_rows for x in held) > 1:
            yield held[0] if len(held) == 1 else pa.concat_batches(held)

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(2)], axis=1)
        starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for start, stop in zip(starts, starts[1:], strict=False):
            own = tuple(keys[start])
            if own != last:
                yield from whole(held)
                held = []
            last = own
            held.append(batch.slice(start, stop - start))
    yield from whole(held)


def _per_tile(of: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            found = of(tile)
            if found.num_rows:
                yield found

    return run


TILE_KEY = ["place", "tile"]
MEMBER = "place long, tile long, side int, node long, size long, cells array<int>"


def _count_reached(members: DataFrame, cosine: float) -> DataFrame:
    """Those of the members ``(place, tile, side, node, size, cells, codes)`` who have a pair to
    be verified, without ``codes``."""

    def of(tile: pa.RecordBatch) -> pa.RecordBatch:
        wanted = _counted(*_sides(tile), _fixed(tile.column("codes")), _earlier(tile), cosine)
        return tile.drop_columns(["codes"]).filter(pa.array(wanted))

    sorted_ = members.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY)
    return sorted_.mapInArrow(_per_tile(of), MEMBER)


def _verified(members: DataFrame, cosine: float) -> DataFrame:
    """``(node, links, edge)`` of the members ``(place, tile, side, node, size, cells,
    embedding)``."""

    def of(tile: pa.RecordBatch) -> pa.RecordBatch:
        across, side = _sides(tile)
        node, size, cells = tile.column("node").to_numpy(), tile.column("size").to_numpy(), _earlier(tile)
        found = [
            _linked(across, side[at], node[at], size[at], values, cells[at], cosine)
            for at, values in _matrices(tile.column("embedding"))
        ]
        columns = [np.concatenate(x) for x in zip(*found, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["node", "links", "edge"])

    sorted_ = members.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY)
    return sorted_.mapInArrow(_per_tile(of), "node long, links long, edge long")


def _cells(keyed: DataFrame, tables: range) -> DataFrame:
    """The ``keyed`` in each of the tables: ``cells`` are those of the tables before it, and
    ``place`` is the table and its own."""
    frame = keyed.withColumn("table_number", F.explode(F.sequence(F.lit(tables.start), F.lit(tables.stop - 1))))
    own = F.get("cells", F.col("table_number")) + F.lit(1 << 31)
    place = F.shiftleft(F.col("table_number").cast("long"), 32) + own
    before = F.slice("cells", F.lit(1), F.col("table_number"))
    return frame.withColumns({"place": place, "cells": before}).drop("table_number")


def _placed(distinct: DataFrame, vectors: DataFrame, number: int, cosine: float) -> tuple[DataFrame, DataFrame, int]:
    """``(node, size, codes, cells)`` of the distinct vectors; the crowded cells, as ``(place,
    parts)``; and the tables. Cells get finer where more pairs meet than such vectors would
    have that have nothing in common, as long as that spares half of them."""
    best, members = None, MEMBERS
    while True:
        parts, tables, directions = shape(number, cosine, members)
        keyed = _keyed(vectors, parts, tables, directions).join(distinct.select("node", "size"), F.col("row") == F.col("node"))
        keyed = stored(keyed.select("node", "size", "codes", "cells"), "vector-cells")
        crowd = stored(_cells(keyed, range(tables)).groupBy("place").agg(F.count("*").alias("n")), "cells")
        met = crowd.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0
        if best is not None and met > best[0] / 2:
            break
        best = met, keyed, crowd, tables
        if met <= CROWDED * tables * number * MEMBERS:
            break
        members /= 2 * CHOICE
    _, keyed, crowd, tables = best
    parts = F.ceil(F.col("n") / TILE).cast("int").alias("parts")
    return keyed, stored(crowd.where(F.col("n") > TILE).select("place", parts), "crowds"), tables


def _links(distinct: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """``(node, links, edge)`` of the distinct vectors ``(node, size)``, whose embeddings are in
    the row ``node`` of the vectors: links that a tile has found, and an edge to a node that
    is no larger."""
    number = distinct.count()
    keyed, crowd, tables = _placed(distinct, vectors, number, cosine)
    links: list[DataFrame] = []
    waiting: list[DataFrame] = []
    begin, rows = 0, 0
    for first in range(0, tables, TABLES):
        last = min(first + TABLES, tables)
        # Each pair of parts of a crowded cell is a tile; a member goes to those of its part.
        members = _cells(keyed, range(first, last)).join(crowd, "place", "left")
        parts = F.coalesce("parts", F.lit(1))
        members = members.withColumn("side", F.pmod(F.xxhash64("node", "place"), parts).cast("int"))
        members = members.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        low, high = F.least("side", "other").cast("long"), F.greatest("side", "other").cast("long")
        members = members.withColumn("tile", F.shiftleft(low, 32).bitwiseOR(high))
        members = members.select("place", "tile", "side", "node", "size", "cells", "codes")
        waiting.append(stored(_count_reached(members, cosine), "vector-pairs"))
        rows += waiting[-1].count()
        if rows <= number / 2 and last < tables:
            continue
        reached = reduce(DataFrame.union, waiting)
        # Most have a pair where near copies are many; then a table at a time is verified.
        at_once = [reached] if rows <= number else [
            reached.where(F.shiftright("place", 32) == t) for t in range(begin, last)
        ]
        for some in at_once:
            found = vectors.select("row", "embedding").join(some, F.col("row") == F.col("node"))
            found = found.select("place", "tile", "side", "node", "size", "cells", "embedding")
            links.append(stored(_verified(found, cosine), "vector-links"))
        waiting, begin, rows = [], last, 0
    return reduce(DataFrame.union, links)


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector of ``(vec_id, embedding)``: ``vec_id, n_links, component_id, kept``.

    A vector that is null, zero or has null or non-finite components links with nothing, and
    neither do vectors of different lengths. ``n_links`` counts rows, copies too. A
    component's id is its smallest ``vec_id``, null only if all are; ``kept`` tells whether
    that is the row's own, false for null. Repeated rows are vectors of their own, so an id
    that occurs twice can be kept twice. An empty table gives an empty result.
    """
    rows = numbered(vectors.select("vec_id", "embedding"), "row")
    usable = rows.where(_usable())
    with shuffles_freed(vectors.sparkSession):
        known = stored(digests(usable), "vectors")
        distinct = known.groupBy("digest").agg(F.min("row").alias("node"), F.count("*").alias("size"))
        distinct = stored(distinct, "vector-classes")
        links = _links(distinct, usable, cosine)
        edges = links.where("node <> edge").select(F.col("node").alias("a"), F.col("edge").alias("b"))
        roots = components(edges, "vector-components")
        counts = links.groupBy("node").agg(F.sum("links").alias("links"))
        of_node = distinct.join(counts, "node", "left").join(roots, "node", "left").select(
            "digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        )
        of_node = stored(of_node, "vector-roots")
        found = stored(known.join(of_node, "digest").select("vec_id", "n_links", "root"), "vector-rows")
        smallest = stored(found.groupBy("root").agg(F.min("vec_id").alias("component_id")), "vector-ids")
    found = found.join(smallest, "root").select("vec_id", "n_links", "component_id")
    others = rows.where(~_usable()).select("vec_id", F.lit(0).cast("long"), "vec_id")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.union(others).withColumn("kept", kept)


def op5_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
