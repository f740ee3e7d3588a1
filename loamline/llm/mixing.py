"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1: knots (time, weight), linear between them. The integral of
a source's schedule is its weight; the weights share out the total demand, no source above `max_repeats` times its
size (the excess goes to the others by weight). A source meets its demand by its documents in a hashed order, again
from the start for repeats; a document's draw begins at a cumulative demand, and the time at which the source's
schedule has demanded that much, the inverse of the integrated schedule, is the draw's training position.

Cumulative sizes inside a source are prefix sums over hashed blocks of about BLOCK_ROWS rows, so a hot source is
spread over many tasks, and the blocks' sums go by runs of RUN blocks. Sizes are counted in one pass over the texts and kept as a narrow table.

Defined cases: null or empty texts have size 0 and are never drawn; the null source is a source; repeated rows count
each on its own; ties in the hashed order fall to doc_id and text; an empty table gives no rows; long texts are only
counted; extra columns, whatever their names, are ignored by plan() and kept by draw(). Sources are few: a row each
comes to the driver, as their weights are the caller's list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.common import columns, materialize

BLOCK_ROWS, RUN = 2_000, 1_000
WORD = r"[^\x20\x09-\x0D]+"
Schedule = tuple[tuple[float, float], ...]


@dataclass(frozen=True)
class Curriculum:
    """schedules repeat over the sources in code-point order, null last; share: demand over all sizes together."""

    schedules: tuple[Schedule, ...] = (((0.0, 7.5), (1.0, 2.5)), ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
    share: float = 1.5
    max_repeats: float = 2.0
    seed: int = 7


def integral(schedule: Schedule) -> float:
    return sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(schedule, schedule[1:], strict=False))


def targets(sizes: list[int], weights: list[float], total: float, max_repeats: float) -> list[float]:
    """total by weight; what is above max_repeats times a size stops there, its excess goes to the rest by weight."""
    out, free, rest = [0.0] * len(sizes), set(range(len(sizes))), total
    while free:
        weight = sum(weights[k] for k in free)
        if weight <= 0:
            break
        over = {k for k in free if rest * weights[k] / weight > max_repeats * sizes[k]}
        if not over:
            for k in free:
                out[k] = rest * weights[k] / weight
            break
        for k in over:
            out[k] = float(max_repeats * sizes[k])
        rest -= sum(out[k] for k in over)
        free -= over
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _sources(sizes: DataFrame, curriculum: Curriculum) -> DataFrame:
    """source, source_size, target, knots: one row a source. The schedules are a table of the caller's own, one entry
    a source, so the sources' totals (and nothing else) come to the driver."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).collect()
    totals.sort(key=lambda r: (r.source is None, r.source or ""))
    schedules = [curriculum.schedules[k % len(curriculum.schedules)] for k in range(len(totals))]
    wanted = targets([r.n for r in totals], [integral(s) for s in schedules], curriculum.share * sum(r.n for r in totals), curriculum.max_repeats)
    rows = []
    for r, schedule, target in zip(totals, schedules, wanted, strict=True):
        knots, done, whole = [], 0.0, integral(schedule) or 1.0
        for (a, v), (b, w) in zip(schedule, schedule[1:], strict=False):
            knots.append((a, b, v / whole, w / whole, done))
            done += (b - a) * (v + w) / 2 / whole
        rows.append((r.source, r.n, -(-r.docs // BLOCK_ROWS), target, knots))
    return sizes.sparkSession.createDataFrame(rows, "source string, source_size long, blocks long, target double, knots array<struct<a:double,b:double,v:double,w:double,done:double>>")


def position(fraction: Column, knots: Column) -> Column:
    """The time at which the integrated schedule reaches fraction of its whole (a root of a quadratic)."""
    k = F.element_at(F.filter(knots, lambda x: x["done"] <= fraction), -1)
    slope = (k["w"] - k["v"]) / (k["b"] - k["a"])
    need = fraction - k["done"]
    root = F.sqrt(F.greatest(k["v"] * k["v"] + 2 * slope * need, F.lit(0.0)))
    return F.least(k["b"], k["a"] + F.when(k["v"] + root > 0, 2 * need / (k["v"] + root)).otherwise(0.0))


def plan(docs: DataFrame, curriculum: Curriculum = Curriculum(), whole: bool = False) -> DataFrame:
    """One row a row of docs: doc_id, source, text_key, size, source_size, target, draws: array of (repeat, taken,
    position). The last draw of a source is cut at its target; with whole=True it is all or nothing, by its middle."""
    d = columns(docs, "doc_id", "source", "text")
    sizes = materialize(
        d.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key"),
            F.xxhash64(F.lit(curriculum.seed), "doc_id", "text").alias("order_key"),
        ),
        "sizes",
    )
    known = F.broadcast(_sources(sizes, curriculum).withColumnRenamed("source", "known"))  # one short row a source
    d = sizes.join(known, F.col("source").eqNullSafe(F.col("known"))).drop("known")
    d = d.withColumn("block", F.floor((F.shiftrightunsigned("order_key", 11).cast("double") / float(1 << 53)) * F.col("blocks")))
    blocks = d.groupBy("source", "block").agg(F.sum("size").alias("block_size")).withColumn("run", F.floor(F.col("block") / RUN))
    # sums in two steps, so that no window holds all blocks of a source
    runs = blocks.groupBy("source", "run").agg(F.sum("block_size").alias("run_size"))
    before = lambda size, within, by: F.coalesce(F.sum(size).over(Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("source").alias("s"), F.col("run").alias("r"), before("run_size", ["source"], "run").alias("run_base"))
    blocks = blocks.join(runs, F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r"))).drop("s", "r")
    blocks = blocks.select(F.col("source").alias("s"), F.col("block").alias("k"), (F.col("run_base") + before("block_size", ["source", "run"], "block")).alias("base"))
    inside = Window.partitionBy("source", "block").orderBy("order_key", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    d = d.join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("k"))).drop("s", "k")
    d = d.withColumn("begin", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))

    def draw(repeat: Column) -> Column:
        start = repeat * F.col("source_size") + F.col("begin")
        if whole:
            taken = F.when(start + F.col("size") / 2 <= F.col("target"), F.col("size")).otherwise(F.lit(0))
        else:
            taken = F.least(F.greatest(F.floor(F.col("target")) - start, F.lit(0)), F.col("size"))
        middle = F.least((start + taken / 2) / F.greatest(F.col("target"), F.lit(1e-9)), F.lit(1.0))
        return F.struct(repeat.cast("int").alias("repeat"), taken.cast("long").alias("taken"), position(middle, F.col("knots")).alias("position"))

    repeats = F.array(*[F.lit(k) for k in range(max(1, -int(-curriculum.max_repeats // 1)))])
    draws = F.filter(F.transform(repeats, draw), lambda x: x["taken"] > 0)
    return d.select("doc_id", "source", "text_key", "size", "source_size", "target", draws.alias("draws"))


def in_order(planned: DataFrame) -> DataFrame:
    """The rows of plan() with taken (words over all draws) and position (of the first draw), sorted by position over
    ranges; what is never drawn comes last."""
    taken = F.expr("aggregate(draws, 0L, (a, x) -> a + x.taken)")
    d = planned.withColumns({"taken": taken, "position": F.try_element_at("draws", F.lit(1))["position"]})
    order = [F.col("position").asc_nulls_last(), F.col("doc_id"), F.col("text_key")]
    return d.repartitionByRange(*order).sortWithinPartitions(*order)


def draw(docs: DataFrame, curriculum: Curriculum = Curriculum()) -> DataFrame:
    """The rows of docs in training order, whole and as often as they are drawn."""
    planned = plan(docs, curriculum, whole=True).groupBy(F.col("doc_id").alias("pd"), F.col("source").alias("ps"), F.col("text_key").alias("pt"))
    # rows of one document draw at different places: one list of draws a row, those without draws last
    lists = F.array_sort(F.collect_list(F.when(F.size("draws") > 0, F.col("draws"))))
    planned = materialize(planned.agg(lists.alias("lists"), F.count("*").alias("of")).filter(F.size("lists") > 0), "draws")
    every = docs.columns
    named = {n: docs[f"`{n}`"] if n in every else F.lit(None) for n in ("doc_id", "source", "text")}
    row = F.struct(*[docs[f"`{c}`"] for c in every]).alias("row")
    keyed = docs.select(row, named["doc_id"].alias("d"), named["source"].alias("s"), F.xxhash64(named["text"]).alias("t"))
    same = F.col("d").eqNullSafe(F.col("pd")) & F.col("s").eqNullSafe(F.col("ps")) & (F.col("t") == F.col("pt"))
    if_one = keyed.join(planned.filter("of = 1"), same).select("row", "d", F.explode(F.flatten("lists")).alias("draw"))
    # of several rows, those equal in all columns are one with a number; they take the lists in the order of the other columns
    several = planned.filter("of > 1")
    other = [F.col("row").getField(c) for c in every if c not in named]
    tag = F.to_json(F.struct(*other), {"ignoreNullFields": "false"}) if other else F.lit("")
    rows = keyed.join(several.drop("lists"), same).withColumn("tag", tag).groupBy("pd", "ps", "pt", "tag").agg(F.first("row").alias("row"), F.first("d").alias("d"), F.count("*").alias("n"))
    rows = rows.withColumn("stop", F.sum("n").over(Window.partitionBy("pd", "ps", "pt").orderBy("tag")))
    a, b = rows.alias("a"), several.alias("b")
    met = a.join(b, F.col("a.pd").eqNullSafe(F.col("b.pd")) & F.col("a.ps").eqNullSafe(F.col("b.ps")) & (F.col("a.pt") == F.col("b.pt")))
    own = F.flatten(F.slice("lists", (F.col("stop") - F.col("n") + 1).cast("int"), F.col("n").cast("int")))
    more = met.select("row", "d", F.explode(own).alias("draw"))
    order = [F.col("draw.position"), F.col("d"), F.col("draw.repeat")]
    return if_one.unionByName(more).repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")
