"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

DataFrame functions only.

1. *Targets.*  Sources share ``share`` of all words by weight; a target stops at ``most`` times its
   source.  With r = cap / weight, the level at which the uncapped ones meet is
   the largest of (goal - caps of smaller r) / (weights of the rest).
2. *Blocks.*  A document falls into one of its source's blocks by a digest of its id, so block
   order is a random permutation of the source.  Whole passes take every block; the last pass takes
   blocks in order up to the target, and of the block at the edge, then of the blocks after it, those documents
   that still fit, in rounds by block and digest order until the room is smaller than every document left.
3. *Splitting tree.*  Each drawn block is one unit of its source's quota.  The root holds all
   quotas; a node deals half of its units to each child, the number from each source drawn from the
   multivariate hypergeometric distribution (one univariate draw per source,
   given what is left).  Leaves are the output shards, with quotas that add up exactly.
4. A source's drawn blocks, permuted, are dealt to the shards in runs of these quotas, so shards are disjoint; rows
   are shuffled within their shard.

Only tables with one row per source, or per block (at most ``MAX_BLOCKS`` per source), are
ever ordered; no source, however large, is gathered in one task.

Edge cases: null text has size 0 and a null source is a source of its own (last); documents of size 0 are taken like others and add no
word; rows that repeat a doc_id within a source share one decision; a source without words has target 0;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import save, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 200_000
MAX_BLOCKS = 4096
LEVELS = 4
SEED = 17


def _digest(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _block(digest: Column, blocks: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % blocks


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: source, number, source_size, target, quota, passes, rest, blocks."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")).cast("double")
    s = sources.withColumn("number", number).withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    everything = Window.partitionBy()
    smaller = Window.orderBy(F.col("cap") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(smaller), F.lit(0.0))
    goal = F.sum("source_size").over(everything) * float(share)
    s = s.withColumn("level", (goal - before("cap")) / (F.sum("weight").over(everything) - before("weight")))
    s = s.withColumn("target", F.least("cap", F.max("level").over(everything) * F.col("weight")))
    s = s.withColumn("quota", F.least(F.round("target"), F.col("cap")).cast("long"))
    words = F.greatest("source_size", F.lit(1))
    s = s.withColumn("passes", F.floor(F.col("quota") / words)).withColumn("rest", F.col("quota") - F.col("passes") * F.col("source_size"))
    blocks = F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("source_size") / block_words)))
    return s.select("source", "number", "source_size", "target", "quota", "passes", "rest", blocks.cast("long").alias("blocks"))


# One draw from the hypergeometric distribution: of `want` units drawn out of `pool`, how many of the `own` marked
# ones.  Weights are walked outwards from the mode (weight 1), ten standard deviations at least; what lies beyond is below
# the resolution of a double.  `u` is uniform in [0, 1).
_UP = "(own - x + 1D) * (want - x + 1D) / (x * (pool - own - want + x * 1D))"
_DOWN = "(x + 1D) * (pool - own - want + x + 1D) / ((own - x) * (want - x * 1D))"
_STEP = f"""named_struct(
    'up', IF(x > mode, s.up * {_UP}, s.up), 'down', IF(x < mode, s.down * {_DOWN}, s.down),
    'sum', s.sum + IF(x > mode, s.up * {_UP}, s.down * {_DOWN}),
    'pick', IF(s.pick IS NULL AND level < s.sum + IF(x > mode, s.up * {_UP}, s.down * {_DOWN}), x, s.pick))"""


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _walk(level: str) -> str:
    start = "named_struct('up', 1D, 'down', 1D, 'sum', 1D, 'pick', IF(level < 1D, mode, CAST(NULL AS BIGINT)))"
    return _let("level", level, f"aggregate(places, {start}, (s, x) -> {_STEP})")


def _draw(pool: str, own: str, want: str, u: str) -> str:
    places = "concat(IF(mode < hi, sequence(mode + 1, hi), array()), IF(mode > lo, sequence(mode - 1, lo, -1), array()))"
    body = _let("total", _walk("-1D") + ".sum", f"coalesce({_walk('u * total')}.pick, mode)")
    body = _let("places", places, body)
    body = _let("hi", "least(own, want, mode + reach)", _let("lo", "greatest(0L, want - (pool - own), mode - reach)", body))
    body = _let("reach", "CAST(ceil(10 * sqrt(want * (own / greatest(pool, 1L)) * (1 - own / greatest(pool, 1L))) + 10) AS BIGINT)", body)
    body = _let("mode", "least(own, want, greatest(0L, want - (pool - own), CAST(floor((want + 1D) * (own + 1D) / (pool + 2D)) AS BIGINT)))", body)
    return _let("pool", pool, _let("own", own, _let("want", want, _let("u", u, body))))


def split_quotas(quotas: DataFrame, levels: int = LEVELS, seed: int = SEED) -> DataFrame:
    """Deal quotas (number, units) to 2**levels shards: shard, number, units, first (units of earlier shards)."""
    ordered = F.sort_array(F.collect_list(F.struct("number", "units")))  # one entry per source
    nodes = quotas.agg(ordered.alias("q")).select(F.lit(0).cast("long").alias("shard"), F.col("q.number").alias("numbers"), F.col("q.units").alias("units"))
    for level in range(levels):
        u = f"(shiftrightunsigned(xxhash64({seed}, {level}, shard, i), 11) / 9007199254740992D)"
        draw = _draw("t.pool", "units[i]", "t.want", u)
        total = "aggregate(units, 0L, (a, b) -> a + b)"
        left = f"""aggregate(sequence(0, size(units) - 1), named_struct('pool', {total}, 'want', {total} div 2, 'out', CAST(array() AS ARRAY<BIGINT>)),
            (t, i) -> {_let('k', draw, "named_struct('pool', t.pool - units[i], 'want', t.want - k, 'out', concat(t.out, array(k)))")}).out"""
        nodes = nodes.withColumn("left", F.expr(f"IF(size(units) = 0, units, {left})"))
        children = F.array(F.struct((F.col("shard") * 2).alias("shard"), F.col("left").alias("units")),
                           F.struct((F.col("shard") * 2 + 1).alias("shard"), F.zip_with("units", "left", lambda a, b: a - b).alias("units")))
        nodes = nodes.select("numbers", F.explode(children).alias("child")).select("child.shard", "numbers", "child.units")
    leaves = nodes.select("shard", F.explode(F.arrays_zip("numbers", "units")).alias("z")).select("shard", F.col("z.numbers").alias("number"), F.col("z.units").alias("units"))
    earlier = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.withColumn("first", F.coalesce(F.sum("units").over(earlier), F.lit(0)))


class Mix:
    """The decisions of one mix, over a written table of (doc_id, source, size)."""

    def __init__(self, sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
                 block_words: int = BLOCK_WORDS, levels: int = LEVELS, seed: int = SEED):
        self.seed = seed
        self.targets = save(source_targets(sized, weights, share, most, block_words), "targets")
        placed = self.place(sized)
        blocks = placed.groupBy("number", "block").agg(F.sum("size").alias("words"))
        blocks = blocks.join(self.targets.select("number", "passes", "rest"), "number")
        upto = F.sum("words").over(Window.partitionBy("number").orderBy("block"))
        blocks = save(blocks.withColumn("end", upto).withColumn("edge", (F.col("rest") < F.col("end")) & (F.col("rest") > F.col("end") - F.col("words")))
                      .withColumn("draws", F.col("passes") + (F.col("end") - F.col("words") < F.col("rest")).cast("long")), "blocks")
        self.edge = self._edge_documents(placed, blocks.where("edge"))
        partly = self.edge.select("number", "block").distinct().withColumn("partly", F.lit(True))
        blocks = blocks.join(partly, ["number", "block"], "left")
        beyond = F.coalesce("partly", F.lit(False)) & ~F.col("edge")
        blocks = blocks.withColumn("draws", F.col("draws") + beyond.cast("long")).withColumn("edge", F.col("edge") | beyond).drop("partly")
        self.blocks = save(self._shards(blocks, levels), "block-shards")

    def place(self, docs: DataFrame) -> DataFrame:
        """Add digest, number (of the source) and block."""
        known = self.targets.select(F.col("source").alias("known_source"), "number", "blocks")
        digested = docs.withColumn("digest", _digest(F.col("doc_id"), self.seed))
        joined = digested.join(known, F.col("source").eqNullSafe(F.col("known_source")))
        return joined.withColumn("block", _block(F.col("digest"), F.col("blocks"))).drop("known_source", "blocks")

    def _edge_documents(self, placed: DataFrame, edges: DataFrame) -> DataFrame:
        """number, block, doc_id of the documents that the last pass takes from the block at the edge and those after it."""
        room = edges.select("number", F.col("block").alias("first"), (F.col("rest") - F.col("end") + F.col("words")).alias("room"))
        left = placed.join(room, "number").where(F.col("block") >= F.col("first"))
        left = left.groupBy("number", "block", "first", "digest", "doc_id", "room").agg(F.sum("size").alias("size"))
        chosen = None
        while True:  # every round but the last takes a document of each source that has one that fits
            left = left.where((F.col("size") <= F.col("room")) & ((F.col("size") > 0) | (F.col("block") == F.col("first"))))
            left = save(left, "edge")
            sums = left.groupBy("number", "block").agg(F.sum("size").alias("words"))  # one row per block
            before = F.sum("words").over(Window.partitionBy("number").orderBy("block")) - F.col("words")
            running = F.sum("size").over(Window.partitionBy("number", "block").orderBy("digest", "doc_id"))
            there = left.join(sums.select("number", "block", before.alias("before")), ["number", "block"])
            reached = there.where(F.col("before") <= F.col("room")).withColumn("running", F.col("before") + running)
            taken = save(reached.where(F.col("running") <= F.col("room")).select("number", "block", "digest", "doc_id", "size"), "edge-taken")
            chosen = taken if chosen is None else chosen.unionByName(taken)
            if taken.where("size > 0").isEmpty():
                return chosen.select("number", "block", "doc_id")
            filled = taken.groupBy("number").agg(F.sum("size").alias("filled"))
            left = left.join(taken.select("number", "digest"), ["number", "digest"], "left_anti").join(filled, "number", "left")
            left = left.withColumn("room", F.col("room") - F.coalesce("filled", F.lit(0))).drop("filled")

    def _shards(self, blocks: DataFrame, levels: int) -> DataFrame:
        """number, block, edge, shards: the shard of each pass that takes the block."""
        units = blocks.groupBy("number").agg(F.sum("draws").alias("units"))
        dealt = split_quotas(units, levels, self.seed).where("units > 0")
        dealt = dealt.select("number", "shard", F.explode(F.expr("sequence(first, first + units - 1)")).alias("draw"))
        drawn = blocks.where("draws > 0").select("number", "block", "edge", F.explode(F.expr("sequence(1L, draws)")).alias("pass"))
        order = Window.partitionBy("number").orderBy(F.xxhash64(F.lit(self.seed), "number", "block", "pass"), "block", "pass")
        drawn = drawn.withColumn("draw", (F.row_number().over(order) - 1).cast("long"))
        taken = drawn.join(dealt, ["number", "draw"])
        return taken.groupBy("number", "block", "edge").agg(F.transform(F.sort_array(F.collect_list(F.struct("pass", "shard"))), lambda p: p["shard"]).alias("shards"))

    def decide(self, placed: DataFrame) -> DataFrame:
        """Add ``shards`` to placed rows: one entry for each time the mix takes the row."""
        chosen = self.edge.select(F.col("number").alias("edge_number"), F.col("doc_id").alias("edge_id"))
        rows = placed.join(self.blocks, ["number", "block"], "left")
        here = F.coalesce("edge", F.lit(False)) & (F.col("number") == F.col("edge_number")) & F.col("doc_id").eqNullSafe(F.col("edge_id"))
        rows = rows.join(chosen, here, "left")
        all_but_last = F.slice("shards", F.lit(1), F.size("shards") - 1)
        shards = F.when(F.col("edge") & F.col("edge_number").isNull(), all_but_last).otherwise(F.col("shards"))
        return rows.withColumn("shards", F.coalesce(shards, F.array().cast("array<long>"))).drop("edge", "edge_number", "edge_id", "block")


def _sized(docs: DataFrame) -> DataFrame:
    return save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sized")


def plan_mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, shards."""
    sized = _sized(docs)
    mix = Mix(sized, **options)
    rows = mix.decide(mix.place(sized)).join(mix.targets.select("number", "source_size", "target"), "number")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")


def mix_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every taken row, as often as it is taken, in shard order and shuffled within its shard; the columns of ``docs``."""
    names = docs.columns
    mix = Mix(_sized(docs), **options)
    whole = docs.select("doc_id", "source", F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    taken = mix.decide(mix.place(whole)).select("row", "digest", F.posexplode("shards").alias("copy", "shard"))
    keyed = taken.withColumn("place", F.xxhash64(F.lit(mix.seed), "digest", "shard", "copy"))
    dealt = keyed.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    return dealt.select(*(F.col("row").getField(c).alias(c) for c in names))
