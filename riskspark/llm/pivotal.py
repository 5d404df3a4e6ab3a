"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A source's documents are to be taken target / size times each, a fraction in general. The whole part is taken
from every document; the fractions are rounded so that the words taken keep to the target. Two documents with
fractions meet: words are moved from one to the other, the direction drawn with the odds that keep each one's
expected copies, until one fraction becomes 0 or 1. That one is decided, the other goes on. A small group is
folded this way down to one undecided document; the groups' residuals meet in groups of the next level, and so
on, a reduction tree that leaves one undecided document per source.

That document may be a long one, and its source would miss its target by up to its words. So documents are
rounded in phases by size: first those that are long, and the words they took too many or too few are spread
evenly over the fractions of the shorter ones, which are rounded next, down to the shortest sizes that have room
for the miss. A phase goes down to where the shorter documents' fractions, in words, can still take up the longest
document so far. Its last document is drawn by its fraction; as all fractions of a source are equal, every
document keeps its expected copies. Where the shorter ones have no room, in the last phase at the latest, the last
document goes to the nearer of 0 and 1 instead: the source misses its target by half that document at most, and
this one document's expectation gives way.

Draws are hashes of the ids met and a seed, so reruns agree and a recomputed task decides the same.

Sources are ordered by code point, NULL last. The size of a text is its number of words; NULL has none. A
document without words adds none to the mix: its copies are drawn alone by the same fraction. Rows with the same
id, source and size are one document stored several times and get the same copies each. A NULL id is such an id.
Empty tables give empty results. Columns beside the three named keep their values; working columns start with
`__mix`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import materialise

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
FAN_IN = 32
#: Fractions this near to 0 or 1 are whole.
NEARLY = 1e-9


def words(text: Column) -> Column:
    """Number of runs of other characters than space and U+0009 to U+000D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = MOST_COPIES, total_share: float = 1.0) -> DataFrame:
    """Per source (source, source_size): its weight by order and its target words.

    Shares by weight are cut at `cap` times the source's size, and the excess is shared out again, until none is
    above. That ends where all sources below their cap have the same words per unit of weight, and no source
    at its cap would have fewer: in the order of cap per weight, the first source whose cap is not reached gives
    that rate.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.lit(list(map(float, weights)))[(F.row_number().over(order) - 1) % len(weights)]
    x = sizes.withColumn("__w", weight).withColumn("__cap", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy(F.lit(0))
    filling = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    want = F.sum("source_size").over(everything) * F.lit(float(total_share))
    rest = want - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    rate = rest / (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
    x = x.withColumn("__rate", rate).withColumn("__open", F.col("__cap") / F.col("__w") >= F.col("__rate"))
    level = F.first(F.when(F.col("__open"), F.col("__rate")), ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least("__cap", F.coalesce(level * F.col("__w"), F.col("__cap")))
    return x.select("source", "source_size", F.col("__w").alias("weight"), target.alias("target"))


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _meet(state: Column, x: Column, seed: int) -> Column:
    """Fold step: `state` has the undecided document `a` (NULL at first) and the decided ones `done`."""
    a = state["a"]
    up = F.least((1 - a["p"]) * a["w"], x["p"] * x["w"])
    down = F.least(a["p"] * a["w"], (1 - x["p"]) * x["w"])
    gain = F.when(_draw(a["key"], x["key"], F.lit(seed)) * (up + down) < down, up).otherwise(-down)

    def moved(d: Column, words_more: Column) -> Column:
        p = d["p"] + words_more / d["w"]
        p = F.when(p < NEARLY, 0.0).when(p > 1 - NEARLY, 1.0).otherwise(p)
        return F.struct(d["key"].alias("key"), p.alias("p"), d["w"].alias("w"))

    both = F.array(moved(a, gain), moved(x, -gain))
    decided = F.filter(both, lambda d: (d["p"] == 0) | (d["p"] == 1))
    left = F.filter(both, lambda d: (d["p"] > 0) & (d["p"] < 1))
    return F.struct(F.when(a.isNull(), x).otherwise(F.get(left, F.lit(0))).alias("a"),
                    F.when(a.isNull(), state["done"]).otherwise(F.concat(state["done"], decided)).alias("done"))


def pivotal_round(units: DataFrame, seed: int = 0, fan_in: int = FAN_IN, nearest: Column | None = None) -> DataFrame:
    """(group, key, taken 0 or 1) for units (group, key long, p in (0, 1), w > 0), by a tree of folds per group.

    A group's last undecided unit is drawn by its fraction; where `nearest` (of the group) holds, it goes to the nearer.

    A group's units meet in about count / fan_in random parts, so that no task holds a group and the part that
    a hot group is cut into is as small as any. Every level is written, so a lost executor costs one level. The
    words taken miss the sum of p * w by less than the words of one unit, the last undecided one.
    """
    kind = "struct<key: bigint, p: double, w: double>"
    nothing = f"named_struct('a', cast(null as {kind}), 'done', cast(array() as array<{kind}>))"
    level = materialise(units.select("group", F.struct("key", "p", "w").alias("x")), "pivotal-units")
    sized = level.groupBy(F.col("group").alias("of")).count()
    most = sized.agg(F.max("count")).first()[0] or 0
    decided, depth = [], 0
    if not most:
        return units.select("group", "key", F.lit(0).alias("taken")).limit(0)
    while True:
        parts = F.ceil(F.col("count") / fan_in).cast("long")
        dealt = level.join(sized, F.col("group").eqNullSafe(F.col("of"))).select("group", "x", parts.alias("parts"))
        part = F.pmod(F.xxhash64(F.col("x.key"), F.lit(seed + depth)), F.col("parts"))
        meeting = dealt.groupBy("group", "parts", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct((-F.col("x.w")).alias("heavy"), F.xxhash64(F.col("x.key"), F.lit(seed + 1000 + depth)).alias("h"), "x"))).alias("all"))
        folded = meeting.select("group", F.aggregate("all", F.expr(nothing), lambda s, e: _meet(s, e["x"], seed)).alias("f"))
        folded = materialise(folded, f"pivotal-{depth}")
        decided.append(folded.select("group", F.explode("f.done").alias("x")))
        rest = folded.filter(F.col("f.a").isNotNull()).select("group", F.col("f.a").alias("x"))
        if most <= 1 or math.ceil(most / fan_in) <= 1:
            cut = _draw(F.col("x.key"), F.lit(seed))
            last = F.when(F.when(F.lit(False) if nearest is None else nearest, 0.5).otherwise(cut) < F.col("x.p"), 1.0).otherwise(0.0)
            decided.append(rest.select("group", F.struct(F.col("x.key").alias("key"), last.alias("p"), F.col("x.w").alias("w")).alias("x")))
            break
        level, depth = rest, depth + 1
        sized = level.groupBy(F.col("group").alias("of")).count()
        most = sized.agg(F.max("count")).first()[0] or 0
        if not most:
            break
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out.select("group", F.col("x.key").alias("key"), F.col("x.p").cast("int").alias("taken"))


def _size_class(w: Column) -> Column:
    """The power of two that a weight reaches."""
    return F.floor(F.log2(w) + 1e-9).cast("int")


def phases(units: DataFrame) -> DataFrame:
    """(group, size, phase) for the size classes of units (group, p, w): longer documents' phases come first.

    A group's table has a row for each power of two that its documents reach. A class starts a phase if the room of
    the shorter classes, the lesser of their fractions and what these leave to 1, covers the class's longest
    document; else it belongs to the phase of the class below it.
    """
    classes = units.groupBy("group", _size_class(F.col("w")).alias("size")).agg(
        F.least(F.sum(F.col("p") * F.col("w")), F.sum((1 - F.col("p")) * F.col("w"))).alias("room"), F.max("w").alias("longest"))
    upward = Window.partitionBy("group").orderBy("size")
    below = F.coalesce(F.sum("room").over(upward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ends = classes.withColumn("starts", (below >= F.col("longest")).cast("int"))
    # Phase boundaries at or above a class, from the longest class down.
    down = Window.partitionBy("group").orderBy(F.desc("size"))
    return ends.select("group", "size", F.coalesce(F.sum("starts").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int").alias("phase"))


def rounded(units: DataFrame, seed: int = 0) -> DataFrame:
    """(group, key, taken 0 or 1) for units (group, key long, p, w > 0), p the same in (0, 1) for all of a group."""
    kinds = materialise(phases(units), "mix-phases").select(F.col("group").alias("of"), F.col("size").alias("class"), "phase")
    same = F.col("group").eqNullSafe(F.col("of")) & (_size_class(F.col("w")) == F.col("class"))
    work = materialise(units.join(kinds, same).select("group", "key", "p", "w", "phase"), "mix-work")
    last = kinds.agg(F.max("phase")).first()[0]
    out = work.select("group", "key", "w", F.lit(0).alias("taken")).limit(0)
    for phase in range((last if last is not None else -1) + 1):
        # What is left of the target, over what is left of the documents; and whether later phases have room for a miss.
        now, later = F.col("phase") == phase, F.col("phase") > phase
        some = lambda when, x: F.sum(F.when(when, x).otherwise(0.0))
        whole = work.groupBy(F.col("group").alias("g")).agg(
            F.sum(F.col("p") * F.col("w")).alias("want"), some(now | later, F.col("w")).alias("rest"), some(later, F.col("w")).alias("later"), F.max(F.when(now, F.col("w"))).alias("longest"))
        spent = out.groupBy(F.col("group").alias("of")).agg(F.sum(F.col("taken") * F.col("w")).alias("spent"))
        share = whole.filter("longest is not null").join(spent, F.col("g").eqNullSafe(F.col("of")), "left")
        share = share.withColumn("share", F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("want") - F.coalesce("spent", F.lit(0.0))) / F.col("rest"))))
        final = F.least(F.col("share"), 1 - F.col("share")) * F.col("later") < F.col("longest")
        share = materialise(share.select("g", "share", final.alias("final")), "mix-share")
        open_ = work.filter(now).join(share, F.col("group").eqNullSafe(F.col("g"))).withColumn("p", F.col("share"))
        clear = F.when(F.col("p") <= NEARLY, 0).when(F.col("p") >= 1 - NEARLY, 1)
        open_ = materialise(open_.withColumn("taken", clear).drop("g", "share"), "mix-open")
        meeting = open_.filter("taken is null").select(F.struct("group", "final").alias("group"), "key", "p", "w")
        met = pivotal_round(meeting, seed + 7919 * phase, nearest=F.col("group.final"))
        # Different documents with one key, 1 in 2^64 pairs, would share a decision.
        met = met.groupBy("key").agg(F.max("taken").alias("drawn"))
        decided = open_.join(met, "key", "left").select("group", "key", "w", F.coalesce("taken", "drawn").alias("taken"))
        out = out.unionByName(materialise(decided, "mix-decided"))
    return out.select("group", "key", "taken")


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = MOST_COPIES, total_share: float = 1.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row's doc_id, source, size, source_size, target and copies (long)."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(F.col(text_col)).alias("size"))
    sized = materialise(sized, "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = materialise(targets(totals, weights, cap, total_share), "mix-targets")
    # One row for each different document; m rows carry it.
    units = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"))
    goal = goal.select(F.col("source").alias("of"), "source_size", "target")
    units = units.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed), "source", "size")
    units = units.withColumn("rate", F.least(rate, F.lit(float(cap)))).withColumn("whole", F.floor(F.col("rate") + NEARLY)).withColumn("p", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0))).withColumn("key", key)
    units = materialise(units, "mix-plan")
    fair = units.filter((F.col("p") > NEARLY) & (F.col("size") > 0))
    taken = rounded(fair.select(F.col("source").alias("group"), "key", "p", (F.col("size") * F.col("m")).cast("double").alias("w")), seed)
    taken = taken.groupBy("key").agg(F.max("taken").alias("taken"))
    alone = F.when((F.col("size") == 0) & (_draw(F.col("key"), F.lit(seed)) < F.col("p")), 1).otherwise(0)
    plan = units.join(taken, "key", "left").withColumn("copies", (F.col("whole") + F.coalesce("taken", alone)).cast("long"))
    return plan.select("doc_id", "source", "size", "source_size", "target", "copies", "m")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = MOST_COPIES, total_share: float = 1.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of the documents, each as often as the mix takes it."""
    plan = mix_plan(docs, weights, cap, total_share, seed, id_col, text_col, source_col)
    plan = plan.select(F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("size").alias("__mix_size"), F.col("copies").alias("__mix_copies"))
    keyed = docs.withColumn("__mix_words", words(F.col(text_col)))
    same = F.col(id_col).eqNullSafe(F.col("__mix_id")) & F.col(source_col).cast("string").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_words") == F.col("__mix_size"))
    kept = keyed.join(plan.filter("__mix_copies > 0"), same)
    return kept.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(*docs.columns)
