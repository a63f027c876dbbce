"""Mixing sources to target weights by a multivariate hypergeometric splitting tree.

Each source's documents stand in a random order (by a seeded hash), passed through up to
twice; a target in words takes a prefix of that sequence. The prefix is cut into blocks of
a fixed number of words. A binary tree over the output shards splits the block counts of
all sources: a node's left child gets, as its share of the node's blocks, a multivariate
hypergeometric draw, which is what dealing out shuffled blocks would give, and the right
child the rest. So the leaves' quotas add up to each source's blocks exactly, without a
single block having been shuffled. Each shard then takes the next blocks of every source,
as many as its quota says, and shuffles what it has.

All of it is DataFrame and SQL functions. The random order within a source is found in two
steps, sums per bucket of hash values and running sums within a bucket, so that no source
is one group however large. What grows with sources times shards are integers only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabtally.llm.common import WORD, free_name, numbered, stored, table

SEED = "mix-1"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 16384
SHARD_WORDS = 4_000_000
#: Leading hex digits of the order's hash that make a bucket.
BUCKET_DIGITS = 3


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, rank, target)`` from ``(source, source_size)``.

    Sources in order of their code points, null last, weigh ``weights``, repeating. They
    share ``share`` times all words; a target stops at ``most`` times its source's words
    and what is above is shared by weight among the others, until none is above: all
    targets are ``least(weight * level, most * size)`` for one level, which is found by
    passing through the sources in the order in which a rising level fills them.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1)
    )
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(most))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    budget = F.sum("source_size").over(whole) * F.lit(share)
    levels = ranked.withColumn(
        "level",
        (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after),
    )
    free = F.when(F.col("cap") > F.col("weight") * F.col("level"), F.col("level"))
    return levels.withColumn("final", F.max(free).over(whole)).select(
        "source",
        "source_size",
        F.col("rank").cast("int").alias("rank"),
        F.when(
            F.col("cap") > F.col("weight") * F.col("final"), F.col("weight") * F.col("final")
        ).otherwise(F.col("cap").cast("double")).alias("target"),
    )


def _hypergeometric(total: str, kind: str, drawn: str, u: str) -> str:
    """SQL for how many of ``kind`` are among ``drawn`` of ``total``, from the uniform ``u``
    by inversion. Only what lies beyond twelve standard deviations, less than a double's
    resolution of u, is left out of the sum.

    A transform of one element gives a value a name, so that every part of the formula is
    in the plan once: the arguments are ``v``, the bounds ``b``, and ``f`` has ln(x!), by
    Stirling's series seven steps up, of the nine factorials of the first probability.
    """
    mean = "(v.n*v.k/cast(v.t AS double))"
    spread = f"(12.0D*sqrt({mean}*(1.0D-v.k/cast(v.t AS double))*(v.t-v.n)/greatest(v.t-1.0D,1.0D))+12.0D)"
    low = f"greatest(0L,v.n-(v.t-v.k),cast(floor({mean}-{spread}) AS bigint))"
    high = f"least(v.n,v.k,cast(ceil({mean}+{spread}) AS bigint))"
    steps = "*".join(f"(x+{i}.0D)" for i in range(1, 8))
    factorial = (
        f"(x+7.5D)*ln(x+8.0D)-(x+8.0D)+{0.5 * math.log(2 * math.pi)!r}D+1.0D/(12.0D*(x+8.0D))"
        f"-1.0D/(360.0D*power(x+8.0D,3))+1.0D/(1260.0D*power(x+8.0D,5))-ln({steps})"
    )
    of = "v.k,b.lo,v.k-b.lo,v.t-v.k,v.n-b.lo,v.t-v.k-v.n+b.lo,v.t,v.n,v.t-v.n"
    first = "exp(f[0]-f[1]-f[2]+f[3]-f[4]-f[5]-f[6]+f[7]+f[8])"
    ratio = "((v.k-i)*(v.n-i*1.0D)/((i+1.0D)*(v.t-v.k-v.n+i+1.0D)))"
    walk = (
        f"aggregate(sequence(b.lo,b.hi),named_struct('p',{first},'c',0.0D,'pick',b.lo),"
        f"(h,i)->named_struct('p',if(i<b.hi,h.p*{ratio},0.0D),'c',h.c+h.p,"
        "'pick',if(h.c+h.p<v.u,least(i+1,b.hi),h.pick)),h->h.pick)"
    )
    named = f"transform(array(transform(array({of}),x->{factorial})),f->{walk})[0]"
    bounded = f"transform(array(named_struct('lo',{low},'hi',{high})),b->{named})[0]"
    draw = f"if(v.k=0 OR v.n=0,0L,if(v.k=v.t,v.n,{bounded}))"
    return f"transform(array(named_struct('t',{total},'k',{kind},'n',{drawn},'u',{u})),v->{draw})[0]"


def _uniform(*parts: str) -> str:
    return f"((xxhash64({','.join(parts)})&9007199254740991)/9007199254740992.0D)"


def quotas(blocks: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """``(shard, rank, first, quota)`` from ``(rank, n_blocks)``: shard takes ``quota``
    blocks of the source from ``first`` on. Each shard gets the same number of blocks up
    to rounding, each source's quotas add up to ``n_blocks``."""
    counts = F.transform(F.array_sort(F.collect_list(F.struct("rank", "n_blocks"))), lambda x: x.n_blocks)
    ranks = F.transform(F.array_sort(F.collect_list("rank")), lambda x: x)
    root = blocks.agg(counts.alias("counts"), ranks.alias("ranks"))
    nodes = root.where("size(counts) > 0").selectExpr(
        "0L AS first_shard", f"{shards}L AS width", "counts", "ranks"
    )
    step = _hypergeometric(
        "a.total", "counts[i]", "a.drawn", _uniform(f"'{seed}'", "first_shard", "width", "ranks[i]")
    )
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        # Total and wanted blocks go down from source to source; what each takes is kept.
        # The pick is used three times, so it is computed in a transform of one element.
        left = f"""aggregate(sequence(0, size(counts) - 1),
            named_struct('total', total, 'drawn', wanted, 'out', cast(array() AS array<bigint>)),
            (a, i) -> transform(array({step}), p -> named_struct('total', a.total - counts[i],
                'drawn', a.drawn - p, 'out', concat(a.out, array(p))))[0],
            a -> a.out)"""
        halves = (
            nodes.withColumn("total", F.expr("aggregate(counts, 0L, (s, x) -> s + x)"))
            .withColumn("wanted", F.expr("(total * (width div 2)) div width"))
            .withColumn("left", F.expr(f"if(width = 1, counts, {left})"))
        )
        nodes = halves.selectExpr(
            "explode(if(width = 1, array(named_struct('first_shard', first_shard, 'width', width,"
            " 'counts', counts)), array(named_struct('first_shard', first_shard, 'width',"
            " width div 2, 'counts', left), named_struct('first_shard', first_shard + width div 2,"
            " 'width', width - width div 2, 'counts',"
            " zip_with(counts, left, (c, l) -> c - l))))) AS n",
            "ranks",
        ).select("n.*", "ranks")
    leaves = nodes.selectExpr(
        "first_shard AS shard", "explode(arrays_zip(ranks, counts)) AS x"
    ).selectExpr("shard", "x.ranks AS rank", "x.counts AS quota")
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.withColumn("first", F.coalesce(F.sum("quota").over(earlier), F.lit(0)))


def plan(
    documents: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
) -> tuple[DataFrame, DataFrame]:
    """What the mix takes of ``documents`` (``row, doc_id, text, source``): the documents
    ``(row, doc_id, size, source_size, target)``, and the draws ``(row, pass, size, shard,
    place)``, each document at most once per pass, ``place`` its random place in the shard.

    Words are runs of anything but ASCII white space; null texts have none. A null source
    is a source. Null or repeated ``doc_id`` are documents like any other; of repeated ones
    with different sizes the smaller is first. Documents without words are never drawn. A
    source's words end within one document's size of its target. A document without an id
    has its place by its text and row, so that these are spread as well.
    """
    unnamed = F.concat_ws(" ", F.lit("null"), F.md5(F.coalesce("text", F.lit(""))), F.col("row").cast("string"))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), unnamed)))
    words = words_in(F.col("text")).alias("size")
    sized = documents.select("row", "doc_id", "source", words, order.alias("place"))
    sized = stored(
        sized.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS)),
        "mix-sizes",
    )
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    wanted = targets(
        buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most
    )
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(
        F.col("source").alias("s"),
        F.col("bucket").alias("b"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"),
    )
    offsets = offsets.join(wanted, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    within = (
        Window.partitionBy("source", "bucket")
        .orderBy("place", "doc_id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = sized.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = stored(
        placed.join(
            offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
        ).select(
            "row", "doc_id", "size", "source_size", "target", "rank", "place",
            (F.col("offset") + F.col("ahead")).alias("start"),
        ),
        "mix-places",
    )
    drawn = placed.select(
        "row", "doc_id", "size", "rank", "target", "place",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.lit(most - 1)),
                lambda p: F.struct(
                    p.alias("pass"), (p * F.col("source_size") + F.col("start")).alias("at")
                ),
            )
        ).alias("draw"),
    ).select("row", "doc_id", "size", "rank", "target", "place", "draw.*")
    # A document is in if more than half of it lies before the target.
    drawn = drawn.where((F.col("size") > 0) & (2 * F.col("at") + F.col("size") <= 2 * F.col("target")))
    drawn = drawn.withColumn("block", F.floor(F.col("at") / F.lit(block_words)))
    blocks = drawn.groupBy("rank").agg((F.max("block") + 1).alias("n_blocks"), F.sum("size").alias("words"))
    blocks = stored(blocks, "mix-blocks")
    words = blocks.agg(F.sum("words")).first()[0] or 0
    shards = max(1, math.ceil(words / shard_words))
    owners = quotas(blocks.select("rank", "n_blocks"), shards, seed).where("quota > 0").select(
        "shard", "rank", F.explode(F.sequence("first", F.col("first") + F.col("quota") - 1)).alias("block")
    )
    mixed = drawn.join(owners, ["rank", "block"]).select(
        "row", "pass", "size", "shard", F.xxhash64(F.lit(seed), "place", "pass").alias("place")
    )
    return placed.select("row", "doc_id", "size", "source_size", "target"), mixed


def mix(documents: DataFrame, **parameters) -> DataFrame:
    """The mixed ``documents``, all their columns, a row for each time one is taken, written
    in shards that are shuffled each. They are read twice and have to come in the same
    order each time, as those of a file scan do."""
    row, shard, place = (free_name(documents, name) for name in ("row", "shard", "place"))
    rows = numbered(documents, row)
    _, draws = plan(rows.select(F.col(row).alias("row"), "doc_id", "text", "source"), **parameters)
    draws = draws.select(F.col("row").alias(row), F.col("shard").alias(shard), F.col("place").alias(place))
    return (
        rows.join(draws, row)
        .repartition(shard)
        .sortWithinPartitions(shard, place, row)
        .drop(row, shard, place)
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = numbered(table(spark, sf_dir, "documents", "doc_id", "text", "source"), "row")
    facts, draws = plan(documents)
    taken = draws.groupBy("row").agg(F.sum("size").alias("taken"))
    return facts.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null ' || md5(coalesce(text, '')))) AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank
  FROM d GROUP BY source),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight, source_size * 2 AS cap FROM s),
l AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT * 1.5e0
             - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, rank)),
f AS (SELECT *, max(CASE WHEN cap > weight * level THEN level END) OVER () AS final FROM l),
t AS (
  SELECT source, source_size,
         CASE WHEN cap > weight * final THEN weight * final ELSE cap::DOUBLE END AS target FROM f),
p AS (
  SELECT d.*, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id NULLS FIRST, size, r
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * ((2 * start + size <= 2 * target)::BIGINT
              + (2 * (source_size + start) + size <= 2 * target)::BIGINT))::BIGINT AS taken
FROM p
"""
