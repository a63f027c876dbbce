"""Source divergence audit: how far the words of each source lie from those of the others.

Two passes over the texts. The first counts exactly in how many documents of a language each
term is, and keeps those of enough. The second recounts the kept ones for each source: the
kept terms of a language are dealt to shards by their hash, each shard gets a minimal perfect
hash that gives its terms the numbers from 0 on, and the workers hold the shards and add up
in an array per group, which has one slot for each term. A perfect hash gives a number to
any word, so a slot stores its term, and a word counts if it is the same.

Shards are made in Spark and are of bounded size. They are broadcast as long as they take
``BROADCAST_BYTES``; beyond that the second pass runs once for each part of them of that
size, with the same result. What is compared then comes by shard: all counts of a shard's
terms meet its stored keys, and sums over terms are added up over shards. So a term, a
source or a language that holds a third of all words is a number in each task's arrays, and
is never gathered.

All numbers are integers. Shares are thousand millionths, rounded down, in three steps of a
thousand each, so that they are exact for counts up to 9 * 10 ** 15.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabtally.llm.common import stored, table

#: Documents of a language that a term is kept from, and ranks of terms that are reported.
LEAST_DOCUMENTS = 3
RANKS = 200
#: Terms and bytes of a shard, about, and cells of terms by sources at a time.
SHARD_TERMS, SHARD_BYTES, CELLS = 8192, 1 << 20, 1 << 22
BROADCAST_BYTES = 48 << 20
#: Memory bounds of a worker: words that are counted by name, and bytes of slots, which
#: hold 32 bits and are emptied before they can overflow.
COUNTED_WORDS, SLOT_BYTES, SLOT_LIMIT = 500_000, 160 << 20, 1 << 31
#: Keys of a bucket, on average, that get their slots together.
BUCKET_KEYS = 3

#: ASCII letters and all beyond ASCII make up terms; the former in lower case.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _terms(text: bytes | None) -> list[bytes]:
    return text.translate(LETTERS).split() if text else []


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("text").cast("binary").alias("text"),
    )


def kept_terms(texts: DataFrame) -> DataFrame:
    """``(lang, term)``: the terms in at least ``LEAST_DOCUMENTS`` documents of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def taken() -> pa.RecordBatch:
            columns = ([], [], [])
            for lang, found in counts.items():
                columns[0].extend([lang] * len(found))
                columns[1].extend(found)
                columns[2].extend(found.values())
            counts.clear()
            kinds = (pa.string(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "term", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts[lang].update(set(_terms(text.as_py())))
                if sum(map(len, counts.values())) > COUNTED_WORDS:
                    yield taken()
        yield taken()

    found = texts.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    found = found.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= LEAST_DOCUMENTS).select("lang", "term")


def _hash(term: bytes) -> int:
    """As Spark's ``xxhash64`` gives it, but without a sign."""
    return xxhash.xxh64_intdigest(term, seed=42)


def _mixed(h: np.ndarray, salt) -> np.ndarray:
    """Other hashes of hashes, a different one for each salt."""
    with np.errstate(over="ignore"):
        h = (h + np.uint64(0x9E3779B97F4A7C15) * (np.asarray(salt, np.uint64) + np.uint64(1))).astype(np.uint64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def perfect_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(displacements, slots)`` of distinct hashes: buckets of keys, largest first, try salts
    until all of a bucket's keys fall into free slots. A key alone gets any free slot, which
    its bucket's displacement then names, as a negative number."""
    m = len(h)
    buckets = max(1, m // BUCKET_KEYS)
    of = (_mixed(h, 0) % np.uint64(buckets)).astype(np.int64)
    members = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of, minlength=buckets))
    sizes = np.diff(ends, prepend=0)
    displacements, slots, free = np.zeros(buckets, np.int64), np.empty(m, np.int64), np.ones(m, bool)
    for bucket in np.argsort(-sizes, kind="stable").tolist():
        size = sizes[bucket]
        if size < 2:
            break
        own = members[ends[bucket] - size : ends[bucket]]
        salt, tries = 1, 16
        while True:
            salts = np.arange(salt, salt + tries)
            places = (_mixed(h[own][None, :], salts[:, None]) % np.uint64(m)).astype(np.int64)
            good = free[places].all(axis=1)
            if size == 2:
                good &= places[:, 0] != places[:, 1]
            else:
                ordered = np.sort(places, axis=1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                break
            salt, tries = salt + tries, min(tries * 4, 4096)
        best = int(good.argmax())
        displacements[bucket] = salts[best]
        slots[own] = places[best]
        free[places[best]] = False
    alone = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(free)
    displacements[alone] = -1 - left
    slots[members[ends[alone] - 1]] = left
    return displacements, slots


def _shard_of(rows: pa.Table) -> pa.Table:
    """A shard's perfect hash and its terms in the order of their slots. Terms whose hashes
    are equal, of which one has its slot by the hash, have the last slots."""
    terms = sorted(rows.column("term").to_pylist())
    h = np.fromiter(map(_hash, terms), np.uint64, len(terms))
    _, first = np.unique(h, return_index=True)
    displacements, slots = perfect_hash(h[first])
    keys = [b""] * len(first)
    for at, slot in zip(first.tolist(), slots.tolist(), strict=True):
        keys[slot] = terms[at]
    others = np.setdiff1d(np.arange(len(terms)), first)
    keys += [terms[at] for at in others.tolist()]
    return pa.table(
        {
            "lang": [rows.column("lang")[0].as_py()],
            "shard": pa.array([rows.column("shard")[0].as_py()], pa.int64()),
            "hashed": pa.array([len(first)], pa.int64()),
            "displacements": pa.array([displacements.tolist()], pa.list_(pa.int64())),
            "keys": pa.array([keys], pa.list_(pa.binary())),
            "bytes": pa.array([sum(map(len, keys)) + 16 * len(keys)], pa.int64()),
        }
    )


SHARD = "lang string, shard long, hashed long, displacements array<long>, keys array<binary>, bytes long"


class Slots:
    """The shards of a language that a worker holds: from terms to slots."""

    def __init__(self, rows: list[dict], shards: int):
        self.shards = shards
        self.hashed, self.buckets, self.first_bucket, self.first_slot = (np.zeros(shards, np.int64) for _ in range(4))
        buckets = slot = 0
        for row in rows:
            at = row["shard"]
            self.hashed[at], self.buckets[at] = row["hashed"], len(row["displacements"])
            self.first_bucket[at], self.first_slot[at] = buckets, slot
            buckets += len(row["displacements"])
            slot += len(row["keys"])
        self.displacements = np.concatenate([np.array(row["displacements"], np.int64) for row in rows])
        self.keys = pa.array([key for row in rows for key in row["keys"]], pa.large_binary())
        self.size = slot
        #: Terms that share their hash with another one.
        self.others = {
            key: int(self.first_slot[row["shard"]]) + at
            for row in rows
            for at, key in enumerate(row["keys"][row["hashed"] :], row["hashed"])
        }
        held = sorted((row["shard"] for row in rows), key=lambda s: self.first_slot[s])
        self.held = np.array(held, np.int64)

    def find(self, terms: list[bytes]) -> np.ndarray:
        """The slots of the terms, -1 for those that have none here."""
        h = np.fromiter(map(_hash, terms), np.uint64, len(terms))
        shard = h.view(np.int64) % self.shards
        there = np.flatnonzero(self.hashed[shard] > 0)
        h, shard = h[there], shard[there]
        bucket = (_mixed(h, 0) % self.buckets[shard].astype(np.uint64)).astype(np.int64)
        salt = self.displacements[self.first_bucket[shard] + bucket]
        place = (_mixed(h, np.maximum(salt, 0)) % self.hashed[shard].astype(np.uint64)).astype(np.int64)
        place = self.first_slot[shard] + np.where(salt < 0, -1 - salt, place)
        # The hash of a word that is no term gives some slot too: the stored key decides.
        found = np.full(len(terms), -1, np.int64)
        own = pa.array([terms[i] for i in there.tolist()], pa.large_binary())
        same = pc.equal(self.keys.take(pa.array(place)), own).to_numpy(zero_copy_only=False)
        found[there] = np.where(same, place, -1)
        if self.others:
            for i, term in enumerate(terms):
                if term in self.others:
                    found[i] = self.others[term]
        return found

    def shard_of(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shard of each slot, and its number there."""
        starts = self.first_slot[self.held]
        shard = self.held[np.searchsorted(starts, slots, "right") - 1]
        return shard, slots - self.first_slot[shard]


COUNTS = "lang string, shard long, source string, slot long, n long"


def recount(texts: DataFrame, slots: dict[str, Slots]) -> DataFrame:
    """``(lang, shard, source, slot, n)``: how often each group has the terms of ``slots``."""
    held = texts.sparkSession.sparkContext.broadcast(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named: dict[tuple[str, str], Counter] = defaultdict(Counter)
        dense: dict[tuple[str, str], np.ndarray] = {}
        added = 0

        def taken() -> Iterator[pa.RecordBatch]:
            nonlocal added
            for (lang, source), numbers in dense.items():
                some = np.flatnonzero(numbers)
                shard, slot = held.value[lang].shard_of(some)
                group = [pa.array([name] * len(some), pa.string()) for name in (lang, source)]
                columns = [group[0], pa.array(shard), group[1], pa.array(slot), pa.array(numbers[some].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "shard", "source", "slot", "n"])
            dense.clear()
            added = 0

        def placed() -> Iterator[pa.RecordBatch]:
            nonlocal added
            for group, words in named.items():
                own = held.value[group[0]]
                found = own.find(list(words))
                n = np.fromiter(words.values(), np.int64, len(words))
                full = group not in dense and 4 * (own.size + sum(map(len, dense.values()))) > SLOT_BYTES
                if full or added + n.sum() >= SLOT_LIMIT:
                    yield from taken()
                if group not in dense:
                    dense[group] = np.zeros(own.size, np.uint32)
                dense[group][found[found >= 0]] += n[found >= 0].astype(np.uint32)
                added += n.sum()
            named.clear()

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2), strict=True):
                if lang not in held.value:
                    continue
                named[lang, source].update(_terms(text.as_py()))
                if sum(map(len, named.values())) > COUNTED_WORDS:
                    yield from placed()
        yield from placed()
        yield from taken()

    return texts.mapInArrow(run, COUNTS)


def _passes(sizes: list, most: int) -> Iterator[list]:
    """Rows with ``bytes`` in turn, as many at a time as take ``most`` bytes."""
    part, total = [], 0
    for row in sizes:
        if part and total + row.bytes > most:
            yield part
            part, total = [], 0
        part.append(row)
        total += row.bytes
    if part:
        yield part


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(10 ** 9 * (count + 1) / total)``, without a product beyond 64 bits."""
    share, rest = np.divmod(count + 1, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        share = share * 1000 + more
    return 1 + share


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pair_sums(n: np.ndarray, p: np.ndarray, none: np.ndarray) -> np.ndarray:
    """For each two groups the sum over terms of ``_far``. Only terms that one of the two has
    are looked at one by one; ``none`` is the share of a term that a group does not have."""
    groups, terms = n.shape
    total, both = np.zeros((groups, groups), np.int64), np.zeros((groups, groups), np.int64)
    for a in range(groups):
        own = np.flatnonzero(n[a])
        shares, there = p[a, own], n[:, own] > 0
        total[a] += _far(shares[None, :], p[:, own]).sum(axis=1)
        total[:, a] += np.where(there, 0, _far(none[:, None], shares[None, :])).sum(axis=1)
        both[a] = there.sum(axis=1)
    has = (n > 0).sum(axis=1)
    neither = terms - has[:, None] - has[None, :] + both
    return total + neither * _far(none[:, None], none[None, :])


RESULT = "lang string, source string, part string, item string, value long"


def _compared(key, counts: pa.Table, shard: pa.Table) -> pa.Table:
    """What a shard's terms add to each pair of sources, and its first terms of each source.
    Among the ``counts`` are rows of slot -1: each group and its denominator."""
    lang = key[0].as_py()
    keys = shard.column("keys")[0].as_py() if len(shard) else []
    slot, n = counts.column("slot").to_numpy(), counts.column("n").to_numpy()
    names = counts.column("source").to_pylist()
    heads = np.flatnonzero(slot < 0)
    heads = heads[np.argsort(np.array([names[i] for i in heads.tolist()], object), kind="stable")]
    sources = [names[i] for i in heads.tolist()]
    number = {source: i for i, source in enumerate(sources)}
    total = n[heads]
    rest = np.flatnonzero(slot >= 0)
    matrix = np.zeros((len(sources), len(keys)), np.int64)
    matrix[[number[names[i]] for i in rest.tolist()], slot[rest]] = n[rest]
    result: dict[str, list] = {"source": [], "part": [], "item": [], "value": []}

    def add(source: str, part: str, items: list, values: list) -> None:
        result["source"] += [source] * len(items)
        result["part"] += [part] * len(items)
        result["item"] += items
        result["value"] += values

    # A language's denominator has its terms once, and each of its sources has them too.
    terms = counts.column("terms")[int(heads[0])].as_py()
    p = _share(matrix, total[:, None])
    none = _share(np.zeros(len(sources), np.int64), np.maximum(total, 1))
    pairs = _pair_sums(matrix, p, none)
    q = _share(matrix.sum(axis=0), np.int64((total - terms).sum() + terms))
    for a, source in enumerate(sources):
        add(source, "pair", sources[:a] + sources[a + 1 :], np.delete(pairs[a], a).tolist())
        above = np.flatnonzero((matrix[a] > 0) & (p[a] > q))
        values = _far(p[a, above], q[above])
        if len(values) > RANKS:
            least = np.partition(values, len(values) - RANKS)[len(values) - RANKS]
            above, values = above[values >= least], values[values >= least]
        best = sorted(zip((-values).tolist(), (keys[i] for i in above.tolist()), strict=True))[:RANKS]
        add(source, "term", [item.decode() for _, item in best], [-value for value, _ in best])
    kinds = {"source": pa.string(), "part": pa.string(), "item": pa.string(), "value": pa.int64()}
    columns = {name: pa.array(values, kinds[name]) for name, values in result.items()}
    return pa.table({"lang": pa.array([lang] * len(result["source"]), pa.string()), **columns})


def divergence(documents: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of the ``documents`` ``(lang, source, text)``.

    Part ``pair``: each other source of the language, how far the group lies from it. Part
    ``term``: the terms that the group has more often than its language, the first
    ``RANKS``. Ranks go by value, descending, then item. Null texts, languages and sources
    are empty ones; other columns are not read. Repeated rows are documents of their own. A
    group without terms has pairs, all from the share of a term never seen; where a language
    keeps no term they are 0. An empty table gives an empty result.
    """
    texts = _texts(documents)
    groups = stored(texts.select("lang", "source").distinct(), "groups")
    terms = stored(kept_terms(texts), "kept-terms")
    facts = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(
        terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum(F.length("term")).alias("bytes")), "lang", "left"
    )
    # As many shards that a shard's terms by all sources fit into the memory of a task.
    size = F.greatest(F.lit(64), F.least(F.lit(shard_terms), F.floor(CELLS / F.col("sources"))))
    shards = F.greatest(F.ceil(F.col("terms") / size), F.ceil(F.col("bytes") / SHARD_BYTES), F.lit(1))
    facts = facts.select("lang", F.coalesce("terms", F.lit(0)).alias("terms"), shards.cast("long").alias("shards"))
    facts = stored(facts, "languages")
    dealt = terms.join(facts, "lang").select("lang", F.expr("pmod(xxhash64(term), shards)").alias("shard"), "term")
    index = stored(dealt.groupBy("lang", "shard").applyInArrow(_shard_of, SHARD), "perfect-hashes")

    sizes = index.join(facts, "lang").select("lang", "shard", "bytes", "shards").orderBy("lang", "shard").collect()
    counted = None
    for part in _passes(sizes, broadcast_bytes):
        first, last = (F.struct(F.lit(r.lang).alias("lang"), F.lit(r.shard).alias("shard")) for r in (part[0], part[-1]))
        own = index.where(F.struct("lang", "shard").between(first, last))
        rows = defaultdict(list)
        for row in own.orderBy("lang", "shard").toArrow().to_pylist():
            rows[row["lang"]].append(row)
        number = {r.lang: r.shards for r in part}
        counts = recount(texts, {lang: Slots(found, number[lang]) for lang, found in rows.items()})
        counts = stored(counts.groupBy("lang", "shard", "source", "slot").agg(F.sum("n").alias("n")), "counts")
        counted = counts if counted is None else counted.union(counts)
    if counted is None:
        counted = documents.sparkSession.createDataFrame([], COUNTS)

    totals = groups.join(counted.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    # Every group meets every shard of its language, also one whose terms it lacks.
    heads = totals.join(facts, "lang").select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"),
        "source",
        F.lit(-1).cast("long").alias("slot"),
        (F.coalesce("n", F.lit(0)) + F.col("terms")).alias("n"),
        "terms",
    )
    counts = counted.withColumn("terms", F.lit(None).cast("long")).unionByName(heads)
    keys = index.select("lang", "shard", "keys")
    both = counts.groupBy("lang", "shard").cogroup(keys.groupBy("lang", "shard"))
    return ranked(stored(both.applyInArrow(_compared, RESULT), "divergences"))


def ranked(parts: DataFrame) -> DataFrame:
    """Sums over shards, in order."""
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    terms = parts.where("part = 'term'")
    rank = F.row_number().over(group)
    both = pairs.withColumn("rank", rank), terms.withColumn("rank", rank).where(F.col("rank") <= RANKS)
    return both[0].unionByName(both[1])


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents", "lang", "source", "text"))


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
m AS (SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (m.n + v) AS p
      FROM m JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (any_value(t) + any_value(v)) AS q
      FROM p JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS t FROM m GROUP BY lang) USING (lang) GROUP BY lang, term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM r)
WHERE part = 'pair' OR rank <= {RANKS}
"""
