"""Keyed tables of many rows: bucketed delta files, upserts and merges of what changes.

Where :class:`SnapshotTable` writes a small table anew, a :class:`KeyedTable` writes the rows
of a commit only. Rows are dealt to buckets by a hash of their key; a commit's rows are a
segment, with a folder for each bucket that they touch, and a manifest lists which segments
each bucket consists of, oldest first. A reader takes, of the rows of a key, that of the last
segment. A bucket that has grown many segments is compacted: its rows are written anew, and
those of other buckets stay as they are.
"""

from __future__ import annotations

import json
import random
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabtally.sources.storage import Storage

BUCKETS = 64
#: Segments of a bucket from which it is compacted.
MOST_SEGMENTS = 8
KEPT_MANIFESTS = 10
ATTEMPTS = 20
NAMED_ANCESTORS = 200
LONGEST_PAUSE = 5.0
DELETED, BUCKET, ORDER = "_deleted", "_bucket", "_order"


@dataclass(frozen=True)
class Manifest:
    """``order``: all segments by commit; ``buckets``: the segments of each bucket."""

    version: int = 0
    id: str = ""
    count: int = 0
    order: list[str] = field(default_factory=list)
    buckets: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    ancestors: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Action:
    """What a merge does with a row. Expressions refer to the columns of the table as
    ``t.name`` and to those of the changes as ``s.name``."""

    kind: str
    values: dict[str, Column | str] | None = None
    when: Column | None = None


def update(values: dict[str, Column | str], when: Column | None = None) -> Action:
    """A row that is in the table takes ``values``; its other columns stay."""
    return Action("update", values, when)


def delete(when: Column | None = None) -> Action:
    """A row that is in the table goes."""
    return Action("delete", None, when)


def insert(values: dict[str, Column | str] | None = None, when: Column | None = None) -> Action:
    """A row that is not in the table is added; without ``values``, as it is."""
    return Action("insert", values, when)


class KeyedTable:
    """Rows by key, on plain Parquet; ``keys`` are columns of ``schema`` and never null.

    A commit is one new manifest, written in a step that refuses to replace one. Of two
    writers, the second puts its segment behind that of the first, or, if it has read a
    bucket that the first changed, works its change out again. A stream's batch is recorded
    with the commit, and is skipped when it comes again. The last ``KEPT_MANIFESTS`` versions
    can be read by readers that began earlier.

    The number of buckets is fixed when the table is made. It should be such that a bucket's
    rows fit a task; the driver handles bucket and segment names only.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = BUCKETS
    ):
        self._spark, self._path, self._keys = spark, path.rstrip("/"), list(keys)
        self._schema = StructType.fromDDL(schema)
        self._buckets = buckets
        self._storage = Storage(spark, self._path)
        missing = [key for key in self._keys if key not in self._schema.names]
        if missing or not self._keys:
            raise ValueError(f"keys have to be columns of the table: {missing or 'none given'}")

    @property
    def _rest(self) -> list[str]:
        return [name for name in self._schema.names if name not in self._keys]

    # Reading

    def _manifest_path(self, version: int) -> str:
        return f"{self._path}/_commits/{version:010d}.json"

    def manifest(self) -> Manifest:
        names = [n for n in self._storage.names(f"{self._path}/_commits") if n[0] != "."]
        if not names:
            return Manifest(count=self._buckets)
        return Manifest(**json.loads(self._storage.read(f"{self._path}/_commits/{max(names)}")))

    def read(self) -> DataFrame:
        """All rows, each key once."""
        found = self.manifest()
        return self._content(found, list(found.buckets))

    def _folder(self, segment: str, bucket: str) -> str:
        return f"{self._path}/segments/{segment}/{BUCKET}={bucket}"

    def _content(self, found: Manifest, buckets: Sequence[str]) -> DataFrame:
        """The rows of some buckets. Buckets of one segment are read as they are; of others the
        last row of a key counts, which is found in the task that has combined its own rows."""
        one = [self._folder(own[0], b) for b in buckets if len(own := found.buckets.get(b, [])) == 1]
        several = [self._folder(s, b) for b in buckets if len(own := found.buckets.get(b, [])) > 1 for s in own]
        stored = StructType([*self._schema.fields]).add(DELETED, "boolean")
        reader = self._spark.read.schema(stored)
        rows = None
        if one:
            rows = reader.parquet(*one)
        if several:
            order = F.create_map(*[F.lit(x) for i, s in enumerate(found.order) for x in (s, i)])
            segment = F.regexp_extract("_metadata.file_path", r"/segments/([^/]+)/", 1)
            parts = reader.parquet(*several).withColumn(ORDER, order[segment])
            last = F.max_by(F.struct(*self._rest, DELETED), ORDER).alias("last")
            newest = parts.groupBy(*self._keys).agg(last).select(*self._keys, "last.*")
            newest = newest.select(*stored.names)
            rows = newest if rows is None else rows.unionByName(newest)
        if rows is None:
            return self._spark.createDataFrame([], self._schema)
        return rows.where(~F.col(DELETED)).drop(DELETED)

    # Writing

    def upsert(self, rows: DataFrame, stream: str | None = None, batch: int = 0, order: Column | None = None) -> bool:
        """Add ``rows`` or put them in the place of those with the same keys; false when the
        batch is there already. Of several rows of a key the last by ``order`` counts;
        without ``order`` such rows are refused, as are null keys."""
        if self._has(self.manifest(), stream, batch):
            return False
        rows = self._keyed(rows.select(*self._schema.names, *([order.alias(ORDER)] if order is not None else [])))
        rest = F.struct(*self._rest)
        if order is None:
            chosen = F.when(F.count("*") > 1, self._refused("two rows")).otherwise(F.any_value(rest))
        else:
            chosen = F.max_by(rest, ORDER)
        # Dealt by bucket first: grouping and writing then need no further shuffle.
        rows = rows.repartition(BUCKET).groupBy(BUCKET, *self._keys).agg(chosen.alias("row"))
        rows = rows.select(BUCKET, *self._keys, "row.*").withColumn(DELETED, F.lit(False))
        segment = self._write(rows)
        for _ in self._attempts():
            base = self.manifest()
            if self._has(base, stream, batch):
                self._drop(segment)
                return False
            if self._is_old(segment, base):
                segment = self._write(rows)
                base = self.manifest()
            if self._commit(base, self._behind(base, segment), stream, batch):
                return True
        raise RuntimeError(f"{self._path} changed {ATTEMPTS} times during an upsert")

    def merge(self, changes: DataFrame, actions: Sequence[Action], stream: str | None = None, batch: int = 0) -> bool:
        """What ``MERGE INTO`` does: each row of ``changes`` meets the row of its key, and the
        first of the ``actions`` that is for such rows and whose condition holds is taken.
        A row for which none is leaves the table as it is. Two changes of one key are
        refused. Only buckets that changes fall into are read."""
        changes = self._keyed(changes)
        columns = [name for name in changes.columns if name not in (BUCKET, *self._keys)]
        one = F.when(F.count("*") > 1, self._refused("two changes")).otherwise(F.any_value(F.struct(F.lit(1).alias(ORDER), *columns)))
        source = changes.groupBy(BUCKET, *self._keys).agg(one.alias("row")).select(BUCKET, *self._keys, "row.*")
        touched = sorted(str(r[BUCKET]) for r in changes.select(BUCKET).distinct().collect())
        for _ in self._attempts():
            base = self.manifest()
            if self._has(base, stream, batch):
                return False
            segment = self._write(self._merged(self._content(base, touched), source, actions))
            while True:
                now = self.manifest()
                changed = any(now.buckets.get(b) != base.buckets.get(b) for b in touched)
                if changed or self._has(now, stream, batch) or self._is_old(segment, now):
                    self._drop(segment)
                    break
                if self._commit(now, self._behind(now, segment), stream, batch):
                    return True
        raise RuntimeError(f"{self._path} changed {ATTEMPTS} times during a merge")

    def _merged(self, target: DataFrame, source: DataFrame, actions: Sequence[Action]) -> DataFrame:
        # By bucket and key, which is how the changes have been grouped.
        same = [F.col(f"s.{name}") == F.col(f"t.{name}") for name in (BUCKET, *self._keys)]
        there = self._keyed(target).withColumn(ORDER, F.lit(1))
        both = source.alias("s").join(there.alias("t"), same, "left")
        matched = F.col(f"t.{ORDER}").isNotNull()
        row = StructType([self._schema[name] for name in self._rest]).add(DELETED, "boolean")
        choice = F.lit(None).cast(row)
        for action in reversed(actions):
            holds = (~matched if action.kind == "insert" else matched) & (F.lit(True) if action.when is None else action.when)
            choice = F.when(F.coalesce(holds, F.lit(False)), self._outcome(action, source)).otherwise(choice)
        keys = [F.col(f"s.{key}").alias(key) for key in self._keys]
        rows = both.select(F.col(f"s.{BUCKET}").alias(BUCKET), *keys, choice.alias("row")).where("row IS NOT NULL")
        return rows.select(BUCKET, *self._keys, "row.*")

    def _outcome(self, action: Action, source: DataFrame) -> Column:
        values = dict(action.values or {})
        fixed = [name for name in values if name not in self._rest]
        if fixed:
            raise ValueError(f"{fixed} cannot be set: only columns of the table that are no keys can")
        columns = []
        for name in self._rest:
            value = values.get(name)
            if value is None and action.kind == "insert" and action.values is None and name in source.columns:
                value = F.col(f"s.{name}")
            if value is None:
                value = F.lit(None) if action.kind == "insert" else F.col(f"t.{name}")
            value = F.expr(value) if isinstance(value, str) else value
            columns.append(value.cast(self._schema[name].dataType).alias(name))
        return F.struct(*columns, F.lit(action.kind == "delete").alias(DELETED))

    def compact(self, most: int = MOST_SEGMENTS) -> int:
        """Write buckets of more than ``most`` segments anew, as one each; how many."""
        for _ in self._attempts():
            base = self.manifest()
            full = [b for b, own in base.buckets.items() if len(own) > most]
            if not full:
                return 0
            rows = self._content(base, full).withColumn(DELETED, F.lit(False))
            segment = self._write(self._keyed(rows))
            there = set(self._touched(segment))
            while True:
                now = self.manifest()
                changed = any(now.buckets.get(b, [])[: len(base.buckets[b])] != base.buckets[b] for b in full)
                if changed or self._is_old(segment, now):
                    self._drop(segment)
                    break
                after = dict(now.buckets)
                for b in full:  # what has come since stays behind it
                    after[b] = [segment] * (b in there) + now.buckets[b][len(base.buckets[b]) :]
                old = set(base.order)
                at = sum(s in old for s in now.order)  # segments drop out, none goes in between
                order = [*now.order[:at], segment, *now.order[at:]]
                if self._commit(now, (order, {b: own for b, own in after.items() if own})):
                    return len(full)
        raise RuntimeError(f"{self._path} changed {ATTEMPTS} times during a compaction")

    # Parts of a commit

    def _refused(self, what: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{what} of the key "), F.to_json(F.struct(*self._keys))))

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """The rows with their buckets; a null key is refused."""
        kinds = {key: self._schema[key].dataType for key in self._keys}
        null = reduce(or_, [F.col(key).isNull() for key in self._keys])
        hashed = F.pmod(F.xxhash64(*[F.col(key).cast(kind) for key, kind in kinds.items()]), F.lit(self.manifest().count))
        bucket = F.when(null, F.raise_error(F.lit("a key is null"))).otherwise(hashed).cast("int")
        return rows.withColumns({key: F.col(key).cast(kind) for key, kind in kinds.items()}).withColumn(BUCKET, bucket)

    def _write(self, rows: DataFrame) -> str:
        segment = f"{self.manifest().version:010d}-{uuid.uuid4().hex}"
        # A bucket is written by one task, so a commit adds one file to it.
        columns = [F.col(c.name).cast(c.dataType).alias(c.name) for c in self._schema]
        rows = rows.select(BUCKET, *columns, DELETED).repartition(BUCKET)
        rows.write.partitionBy(BUCKET).parquet(f"{self._path}/segments/{segment}")
        return segment

    def _touched(self, segment: str) -> list[str]:
        names = self._storage.names(f"{self._path}/segments/{segment}")
        return [n.partition("=")[2] for n in names if n.startswith(f"{BUCKET}=")]

    def _behind(self, base: Manifest, segment: str) -> tuple[list[str], dict[str, list[str]]]:
        touched = self._touched(segment)
        return [*base.order, segment], base.buckets | {b: [*base.buckets.get(b, []), segment] for b in touched}

    def _drop(self, segment: str) -> None:
        self._storage.delete(f"{self._path}/segments/{segment}")

    @staticmethod
    def _is_old(segment: str, found: Manifest) -> bool:
        """Whether a segment that is not in use may have been dropped."""
        return int(segment.split("-")[0]) <= found.version - KEPT_MANIFESTS

    @staticmethod
    def _has(found: Manifest, stream: str | None, batch: int) -> bool:
        return stream is not None and batch <= found.batches.get(stream, -1)

    @staticmethod
    def _attempts():
        for attempt in range(ATTEMPTS):
            if attempt:
                time.sleep(random.uniform(0.5, 1) * min(0.05 * 2**attempt, LONGEST_PAUSE))
            yield attempt

    def _commit(self, base: Manifest, after: tuple, stream: str | None = None, batch: int = 0) -> bool:
        """Make ``after`` the version behind ``base``; false if there is one already."""
        order, buckets = after
        used = {segment for own in buckets.values() for segment in own}
        new = Manifest(
            base.version + 1,
            uuid.uuid4().hex,
            base.count,
            [segment for segment in order if segment in used],
            buckets,
            base.batches | ({} if stream is None else {stream: batch}),
            [i for i in [base.id, *base.ancestors] if i][:NAMED_ANCESTORS],
        )
        if self.manifest().version >= new.version:
            return False
        try:
            self._storage.write_new(self._manifest_path(new.version), json.dumps(asdict(new)))
        except FileExistsError:
            return False
        newest = self.manifest()
        if new.id not in (newest.id, *newest.ancestors):
            # The slot was free only since the versions of that time have been dropped.
            self._storage.delete(self._manifest_path(new.version))
            return False
        self._clean(new.version)
        return True

    def _clean(self, version: int) -> None:
        """Drop manifests that are out of readers' reach, and segments that none lists. A
        segment of a writer that has not committed yet is younger than those."""
        oldest = version - KEPT_MANIFESTS
        if oldest <= 0:
            return
        folder = f"{self._path}/_commits"
        kept: set[str] = set()
        for name in self._storage.names(folder):
            if name[0] == ".":
                continue
            if int(name.split(".")[0]) <= oldest:
                self._storage.delete(f"{folder}/{name}")
            else:
                kept.update(Manifest(**json.loads(self._storage.read(f"{folder}/{name}"))).order)
        for segment in self._storage.names(f"{self._path}/segments"):
            if segment not in kept and int(segment.split("-")[0]) < oldest:
                self._drop(segment)
