"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

Sources get word targets from their weights.  A source's documents fall into
blocks by a hash; whole passes over all blocks, further whole blocks and part
of one last block make up its target.  These block draws are the quotas that
the tree splits: at each node a share of the draws goes left, drawn without
replacement from all sources' quotas, until every output shard has its exact
quota of each source's blocks.  Shards then take disjoint stretches of each
source's permuted draws and order their documents by a hash.

DataFrame functions only; all draws come from hashes, so reruns agree.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_or_shuffled, stage

#: Documents a block, output shards, and how often a document may be taken.
BLOCK_DOCS, SHARDS, MOST_EPOCHS = 256, 16, 3
#: The weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
SEED = 20_240_601


def word_count(text: Column) -> Column:
    """The number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _unit(id_col: Column, text: Column, seed: int) -> Column:
    """The hash that places a document; without an id its text stands in."""
    return F.xxhash64(F.lit(seed), id_col, F.when(id_col.isNull(), F.xxhash64(text)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(k, source, n_docs, source_size, target) of every source in ``sizes`` (source, size).

    Sources in code-point order, null last, weigh ``weights``, repeating, and
    share the sum of all sizes; a target stops at ``most`` times its source's
    size, and the excess is shared by weight among the others until none is
    above: the level at which it ends is found in one pass over the sources
    sorted by cap / weight."""
    s = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    everything, by_name = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    s = s.withColumn("k", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")).cast("double"))
    s = s.withColumn("cap", (most * F.col("source_size")).cast("double")).withColumn("tight", F.col("cap") / F.col("weight"))
    before = everything.orderBy("tight", "k").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    s = s.withColumn("level", level)
    last = F.min(F.when(F.col("level") <= F.col("tight"), F.struct("tight", "k", "level"))).over(everything)
    s = s.withColumn("level", F.coalesce(last["level"], F.lit(0.0)))
    return s.select("k", "source", "n_docs", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


# ---- the splitting tree --------------------------------------------------------

def _uniform(*of: Column | int) -> Column:
    """A number in [0, 1) that depends on its arguments alone."""
    h = F.xxhash64(*[F.lit(x) if isinstance(x, int) else x for x in of])
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _log_factorial(x: Column) -> Column:
    """ln(x!), by Stirling's series eight places further on."""
    def series(z: Column) -> Column:
        w = z + 8.0
        shift = z
        for i in range(1, 8):
            shift = shift * (z + float(i))
        return (w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi) + (1 / 12 - (1 / 360 - 1 / 1260 / (w * w)) / (w * w)) / w - F.log(shift)
    return _let(x.cast("double") + 1.0, series)


def _hypergeometric(u: Column, own: Column, drawn: Column, every: Column) -> Column:
    """How many of ``own`` of ``every`` things are among ``drawn`` of them, as
    the uniform number ``u`` says: values are visited from the likeliest
    outwards until their probabilities pass it.  Ten standard deviations on
    either side are visited at most (what lies beyond has a probability under
    1e-20), so the work grows with the square root of ``own``."""
    d = lambda c: c.cast("double")
    zero, one = F.lit(0).cast("long"), F.lit(1.0)

    def known(v: Column) -> Column:
        mode = F.greatest(v["low"], F.least(v["high"], F.floor((d(v["drawn"]) + 1) * (d(v["own"]) + 1) / (d(v["every"]) + 2)).cast("long")))
        return _let(mode, lambda m: _let(likeliest(v, m), lambda p: walk(v, m, p)))

    def likeliest(v: Column, m: Column) -> Column:
        terms = F.array(v["own"], v["other"], v["drawn"], v["every"] - v["drawn"], m, v["own"] - m, v["drawn"] - m, v["other"] - v["drawn"] + m, v["every"])
        signs = F.array(*[F.lit(float(x)) for x in (1, 1, 1, 1, -1, -1, -1, -1, -1)])
        logs = F.zip_with(terms, signs, lambda x, sign: sign * _log_factorial(x))
        return F.exp(F.aggregate(logs, F.lit(0.0), lambda a, x: a + x))

    def below(v: Column, k: Column, p: Column) -> Column:  # from the probability of k to that of k - 1; -1: there is none
        return F.when(k > v["low"], p * d(k) * d(v["other"] - v["drawn"] + k) / (d(v["own"] - k + 1) * d(v["drawn"] - k + 1))).otherwise(-one)

    def above(v: Column, k: Column, p: Column) -> Column:
        return F.when(k < v["high"], p * d(v["own"] - k) * d(v["drawn"] - k) / (d(k + 1) * d(v["other"] - v["drawn"] + k + 1))).otherwise(-one)

    def state(lo, hi, p_lo, p_hi, seen, got):
        return F.struct(lo.alias("lo"), hi.alias("hi"), p_lo.alias("p_lo"), p_hi.alias("p_hi"), seen.alias("seen"), got.alias("got"))

    def walk(v: Column, m: Column, p: Column) -> Column:
        share = d(v["own"]) / F.greatest(d(v["every"]), one)
        spread = F.sqrt(F.greatest(d(v["drawn"]) * share * (1 - share), F.lit(0.0)))
        steps = F.least(v["high"] - v["low"], (20 * spread).cast("long") + 20)
        turns = F.when(v["u"] < p, F.lit(0).cast("long")).otherwise(steps)
        turns = F.when(turns > 0, F.sequence(F.lit(1).cast("long"), turns)).otherwise(F.array().cast("array<bigint>"))

        def visit(s: Column, _: Column) -> Column:
            def down() -> Column:  # the likelier neighbour of those visited comes next
                seen = s["seen"] + s["p_lo"]
                return state(s["lo"] - 1, s["hi"], below(v, s["lo"] - 1, s["p_lo"]), s["p_hi"], seen, F.when(v["u"] < seen, s["lo"] - 1))

            def up() -> Column:
                seen = s["seen"] + s["p_hi"]
                return state(s["lo"], s["hi"] + 1, s["p_lo"], above(v, s["hi"] + 1, s["p_hi"]), seen, F.when(v["u"] < seen, s["hi"] + 1))
            return F.when(s["got"].isNotNull(), s).when(s["p_lo"] >= s["p_hi"], down()).otherwise(up())

        begin = state(m, m, below(v, m, p), above(v, m, p), p, F.lit(None).cast("long"))
        return F.coalesce(F.aggregate(turns, begin, visit, lambda s: s["got"]), m)

    other = every - own
    given = F.struct(u.alias("u"), own.alias("own"), other.alias("other"), drawn.alias("drawn"), every.alias("every"),
                     F.greatest(zero, drawn - other).alias("low"), F.least(own, drawn).alias("high"))
    return _let(given, known)


def _split(quotas: Column, node: Column, left: Column, seed: int) -> Column:
    """How many of each source's draws go left when ``left`` of all draws do,
    drawn without replacement: source after source, hypergeometric in what is
    still wanted left of what is still to come."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q)

    def of_source(state: Column, x: Column) -> Column:
        got = _hypergeometric(_uniform(seed, node, x["k"]), x["q"], state["left"], state["all"])
        return F.struct((state["left"] - got).alias("left"), (state["all"] - x["q"]).alias("all"),
                        F.concat(state["out"], F.array(got)).alias("out"))

    start = F.struct(left.alias("left"), total.alias("all"), F.array().cast("array<bigint>").alias("out"))
    numbered = F.transform(quotas, lambda q, k: F.struct(k.alias("k"), q.alias("q")))
    return F.aggregate(numbered, start, of_source, lambda s: s["out"])


def shard_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(shard, quotas): the exact quota of every source's draws in each shard,
    from one row ``quotas`` (array<long>, by source); the shards' totals
    differ by one draw at most."""
    parts = int(quotas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    node = quotas.select("quotas", F.lit(1).cast("long").alias("node"), F.lit(0).alias("first"), F.lit(shards).alias("n"))
    width = shards
    while width > 1:
        here = F.col("n") > 1
        half = F.when(here, F.floor(F.col("n") / 2)).otherwise(F.lit(1)).cast("int")
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
        left = F.floor(total * half / F.col("n")).cast("long")
        node = node.withColumn("to_left", F.when(here, _split(F.col("quotas"), F.col("node"), left, seed)).otherwise(F.col("quotas")))
        rest = F.zip_with("quotas", "to_left", lambda a, b: a - b)
        halves = F.array(
            F.struct(F.col("to_left").alias("quotas"), (2 * F.col("node")).alias("node"), F.col("first"), half.alias("n")),
            F.struct(rest.alias("quotas"), (2 * F.col("node") + 1).alias("node"), (F.col("first") + half).alias("first"),
                     (F.col("n") - half).alias("n")))
        node = node.select(F.explode(halves).alias("x")).select("x.*").filter("n > 0").repartition(parts, "node")  # a task a node
        width = -(-width // 2)
    return node.select(F.col("first").alias("shard"), "quotas")


# ---- blocks and draws -------------------------------------------------------------

class Mix:
    """A mix that is settled: ``sources``, and the draws of every ``block``
    (k, block, draws array<struct<epoch, shard>>, picked array<long> or null:
    the documents that the last, partial draw takes)."""

    def __init__(self, sources: DataFrame, blocks: DataFrame, units: DataFrame, block_docs: int, seed: int):
        self.sources, self.blocks, self.units, self.block_docs, self.seed = sources, blocks, units, block_docs, seed


def _block(unit: Column, n_docs: Column, block_docs: int) -> Column:
    return F.pmod(unit, F.ceil(n_docs / block_docs).cast("long")).cast("long")


#: Rows of a source over which one task sums; the sums of such groups are added up apart.
GROUP = 1024


def _begins(df: DataFrame, group: Column, value: str, *order: str) -> DataFrame:
    """``df`` with ``begin``: the sum of ``value`` over its source's rows before
    each row.  ``group`` is monotone in ``order``: rows are summed within a
    group, and a row a group meets in a window a source."""
    df = df.withColumn("_g", group)
    sums = df.groupBy("k", "_g").agg(F.sum(value).alias("_s"))
    before = Window.partitionBy("k").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("k", "_g", F.coalesce(F.sum("_s").over(before), F.lit(0).cast("long")).alias("_before"))
    inside = Window.partitionBy("k", "_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0).cast("long")))
    return df.join(sums, ["k", "_g"]).withColumn("begin", F.col("_before") + F.col("_inside")).drop("_g", "_before", "_inside")


def _fill(docs: DataFrame) -> DataFrame:
    """(k, block, picked): of every block's documents (k, block, want, unit,
    size) those whose words come near to ``want``, by their hashes.

    In permuted order the documents that fit are in, then the best exchange of
    one that is in (or none) for one that is not (or none) is made.  The best
    partner of a document is the next larger or smaller size among the others,
    found by sorting both together.  A block is bounded by ``block_docs``."""
    def one(s: Column, d: Column) -> Column:
        fits = s["sum"] + d["size"] <= F.col("want")
        return F.struct((s["sum"] + F.when(fits, d["size"]).otherwise(0)).alias("sum"),
                        F.concat(s["in"], F.array(fits)).alias("in"))

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = (docs.repartition(parts, "k", "block").groupBy("k", "block", "want")  # by count: few bytes, much work
             .agg(F.sort_array(F.collect_list(F.struct("unit", "size"))).alias("docs")))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<boolean>").alias("in"))
    whole = whole.withColumn("_taken", F.aggregate("docs", start, one))
    docs = stage(whole.select("k", "block", (F.col("want") - F.col("_taken.sum")).alias("_gap"), F.inline(F.arrays_zip("docs", F.col("_taken.in").alias("in"))))
                 .select("k", "block", "_gap", "docs.unit", "docs.size", F.col("in").alias("_in")), "partial")
    nobody = docs.groupBy("k", "block", "_gap").agg(F.lit(0).cast("long").alias("size"))
    none = F.lit(None).cast("long").alias("unit")
    # taking x out leaves a gap of gap + size(x), to be filled by some y
    leaves = docs.filter("_in").select("k", "block", (F.col("_gap") + F.col("size")).alias("v"), "unit").union(
        nobody.select("k", "block", F.col("_gap").alias("v"), none)).withColumn("y", F.lit(False))
    fills = docs.filter("not _in").select("k", "block", F.col("size").alias("v"), "unit").union(
        nobody.select("k", "block", F.col("size").alias("v"), none)).withColumn("y", F.lit(True))
    sorted_ = Window.partitionBy("k", "block").orderBy("v", "y", "unit")
    y = F.when(F.col("y"), F.struct("v", "unit"))
    both = leaves.union(fills).withColumn("_less", F.last(y, ignorenulls=True).over(sorted_.rowsBetween(Window.unboundedPreceding, 0)))
    both = both.withColumn("_more", F.first(y, ignorenulls=True).over(sorted_.rowsBetween(0, Window.unboundedFollowing)))
    options = both.filter("not y").select("k", "block", "v", "unit", F.explode(F.array("_less", "_more")).alias("to")).filter("to is not null")
    best = options.groupBy("k", "block").agg(F.min(F.struct(F.abs(F.col("v") - F.col("to.v")).alias("off"), F.col("unit").alias("less"),
                                                            F.col("to.unit").alias("more"))).alias("_best"))
    kept = docs.join(best, ["k", "block"])
    stays = (F.col("_in") & ~F.col("unit").eqNullSafe(F.col("_best.less"))) | F.coalesce(F.col("unit") == F.col("_best.more"), F.lit(False))
    return kept.groupBy("k", "block").agg(F.collect_list(F.when(stays, F.col("unit"))).alias("picked"))


def plan_mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...] = WEIGHTS,
             shards: int = SHARDS, block_docs: int = BLOCK_DOCS, most: int = MOST_EPOCHS, seed: int = SEED) -> Mix:
    """Settle which documents the mix takes, how often, and into which shard.

    A source with target t and size s has floor(t / s) passes over all its
    blocks; whole blocks in permuted order and a part of the next one give the
    rest, so its words come to t within what one exchange of documents of that
    block can settle, and no document is taken more than ``most`` times.  Null texts
    have size 0, null sources are a source of their own, null ids are placed
    by their text; rows that repeat an id in a source are taken together.
    Sources of size 0 have target 0 and are not taken; an empty table gives an
    empty mix.  Texts are read once, for their sizes; what is shuffled are the
    sizes, and the tree works on one number a source, with work that grows with
    the square root of its draws."""
    units = stage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                              word_count(F.col(text_col)).alias("size"),
                              _unit(F.col(id_col), F.col(text_col), seed).alias("unit")), "sizes")
    sources = stage(source_targets(units, weights, most), "sources")
    s = sources.withColumn("full", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most)))
                           .otherwise(0).cast("int"))
    s = s.withColumn("rest", F.round(F.col("target") - F.col("full") * F.col("source_size")).cast("long"))
    placed = units.join(s, units["source"].eqNullSafe(s["source"])).select(
        "k", _block(F.col("unit"), F.col("n_docs"), block_docs).alias("block"), "unit", "size", "full", "rest")
    sums = placed.groupBy("k", "block", "full", "rest").agg(F.sum("size").alias("size"))
    sums = _begins(sums, F.floor(F.col("block") / GROUP), "size", "block").withColumn("end", F.col("begin") + F.col("size"))
    blocks = stage(sums.withColumn("whole", (F.col("end") <= F.col("rest")) & (F.col("rest") > 0))
                   .withColumn("part", (F.col("begin") < F.col("rest")) & (F.col("rest") < F.col("end")))
                   .withColumn("epochs", F.col("full") + (F.col("whole") | F.col("part")).cast("int"))
                   .filter("epochs > 0"), "blocks")
    # the documents of the partial blocks, one block a source; repeated rows count together
    last = blocks.filter("part").select("k", "block", (F.col("rest") - F.col("begin")).alias("want"))
    some = placed.join(last, ["k", "block"]).groupBy("k", "block", "want", "unit").agg(F.sum("size").alias("size"))
    picked = _fill(some)
    # draws, permuted within their source, and the shards' stretches of them
    draws = blocks.select("k", "block", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)).alias("epoch"))
    draws = draws.withColumn("_h", F.xxhash64(F.lit(seed), "k", "block", "epoch")).withColumn("_one", F.lit(1).cast("long"))
    draws = _begins(draws, F.shiftright("_h", 52), "_one", "_h", "block", "epoch").withColumn("nth", F.col("begin") + 1)
    by_source = s.select("k").join(blocks.groupBy("k").agg(F.sum("epochs").alias("q")), "k", "left")
    quotas = by_source.agg(F.transform(F.sort_array(F.collect_list(F.struct("k", F.coalesce("q", F.lit(0)).cast("long").alias("q")))),
                                       lambda x: x["q"]).alias("quotas"))
    split = stage(shard_quotas(quotas, shards, seed), "quotas")
    ends = (split.select("shard", F.posexplode("quotas").alias("k", "q"))
            .withColumn("end", F.sum("q").over(Window.partitionBy("k").orderBy("shard"))))
    stretch = ends.groupBy("k").agg(F.sort_array(F.collect_list("end")).alias("ends"))
    dealt = draws.join(stretch, "k").select(
        "k", "block", "epoch", F.size(F.filter("ends", lambda e: e < F.col("nth"))).alias("shard"))
    per_block = dealt.groupBy("k", "block").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("draws"))
    settled = per_block.join(blocks.select("k", "block", "full"), ["k", "block"]).join(picked, ["k", "block"], "left")
    return Mix(sources, small_or_shuffled(settled, "draws", 200_000), units, block_docs, seed)


def _drawn(rows: DataFrame, mix: Mix, unit: Column, source: Column) -> DataFrame:
    """``rows`` with ``_source`` (struct of its source) and ``_draws``: the (epoch, shard) of its copies."""
    src = small_or_shuffled(mix.sources, "sources", 100_000).select(F.struct("*").alias("_source"))
    out = rows.withColumn("_unit", unit).join(src, source.eqNullSafe(F.col("_source.source")))
    out = out.withColumn("_block", _block(F.col("_unit"), F.col("_source.n_docs"), mix.block_docs))
    blocks = mix.blocks.select(F.col("k").alias("_k"), F.col("block").alias("_b"), "draws", "full", "picked")
    blocks = blocks.select("_k", "_b", F.struct("draws", "full", "picked").alias("_plan"))
    out = out.join(blocks, (F.col("_source.k") == F.col("_k")) & (F.col("_block") == F.col("_b")), "left")
    p = F.col("_plan")
    taken = F.when(p["picked"].isNull() | F.array_contains(p["picked"], F.col("_unit")), p["draws"]).otherwise(
        F.filter(p["draws"], lambda d: d["epoch"] < p["full"]))
    none = F.array().cast("array<struct<epoch:int,shard:int>>")
    return out.withColumn("_draws", F.coalesce(taken, none)).drop("_k", "_b", "_block", "_plan")


def taken_words(mix: Mix, id_col: str) -> DataFrame:
    """(id_col, size, source_size, target, taken, shards) of every document:
    ``taken`` counts the words of all its copies, ``shards`` has the output
    shard of each."""
    return _drawn(mix.units, mix, F.col("unit"), F.col("source")).select(
        F.col("id").alias(id_col), "size", F.col("_source.source_size").alias("source_size"),
        F.col("_source.target").alias("target"), (F.col("size") * F.size("_draws")).alias("taken"),
        F.transform("_draws", lambda d: d["shard"]).alias("shards"))


def mixed_rows(docs: DataFrame, mix: Mix, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The mix itself: the rows of ``docs`` with their columns, once a copy, a
    partition holding whole shards, each shard in its own permuted order."""
    columns = docs.columns
    rows = _drawn(docs.select(F.struct(*[docs[c] for c in columns]).alias("_row")), mix,
                  _unit(F.col("_row")[id_col], F.col("_row")[text_col], mix.seed), F.col("_row")[source_col])
    copies = rows.select("_row", "_unit", F.explode("_draws").alias("_draw"))
    nth = F.xxhash64(F.lit(mix.seed), "_draw", "_unit")
    spread = F.pmod(nth, F.lit(64))  # a shard is as many sorted runs, so that no task holds it whole
    return (copies.select("_row", F.col("_draw.shard").alias("_shard"), spread.alias("_run"), nth.alias("_nth"))
            .repartition("_shard", "_run").sortWithinPartitions("_shard", "_run", "_nth").select("_row.*"))
