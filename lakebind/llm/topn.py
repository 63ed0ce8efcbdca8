"""The N best items of every group, by simultaneous bisection of per-group cutoffs.

Every item has an order-preserving integer code: its score on a scale of 2^48 steps over all finite scores, the bits of
the score, then the tie text in blocks of six bytes, then the id, each part small enough to be exact in a double. All groups search for the code of their N-th item at once. A round
divides the open interval of each group's current part by ``fanout - 1`` midpoints, counts the rows above each, and keeps
the piece in which the N-th item lies; an interval of one value moves the group on, past all that its remaining texts have
in common. A part is worked out only for the groups that have come to it, from one expression whatever the length of the
texts. A group is done when its cutoff holds exactly N rows, so it never sorts, and rows out of the interval leave the
following rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebind.storage import cut, shuffle_partitions

BLOCK = 6
#: The code of a null, after all others.
LAST = -float(2**49)


class _Code:
    """The parts of the code: three of the score, then those of the tie, then those of the item; larger ones come first."""

    def __init__(self, types: dict[str, T.DataType], longest: dict[str, int], least: float, most: float):
        self.least, self.span = least / 2, most / 2 - least / 2
        self.text = {c: isinstance(types[c], T.StringType) for c in ("t", "i")}
        self.blocks = {c: -(-longest[c] // BLOCK) + 1 if self.text[c] else 2 for c in ("t", "i")}
        self.tie = 3
        self.item = self.tie + self.blocks["t"]
        self.size = self.item + self.blocks["i"]

    def step(self) -> Column:
        """The first part: where the score lies between the least and the greatest finite one."""
        step = F.floor((F.col("s") / 2 - self.least) / self.span * F.lit(2.0**48)).cast("double") if self.span > 0 else F.lit(0.0)
        return F.when(F.col("s") == float("inf"), 2.0**49).when(F.col("s") == -float("inf"), -1.0).otherwise(step)

    def score(self, k: Column) -> Column:
        return F.when(k == 0, self.step()).when(k == 1, F.shiftright("bits", 32).cast("double")).otherwise(F.col("bits").bitwiseAND(F.lit(0xFFFFFFFF)).cast("double"))

    def part(self, k: Column, t: Column | None = None, i: Column | None = None) -> Column:
        """Part ``k`` (a column) of a row's code."""
        t, i = F.col("t") if t is None else t, F.col("i") if i is None else i
        return F.when(k < self.tie, self.score(k)).when(k < self.item, self._of("t", t, k - self.tie)).otherwise(self._of("i", i, k - self.item))

    def _of(self, name: str, value: Column, block: Column) -> Column:
        if self.text[name]:
            raw = F.hex(F.substring(F.encode(value, "utf-8"), block * BLOCK + 1, F.lit(BLOCK)))
            number = F.when(block < self.blocks[name] - 1, F.conv(F.rpad(raw, 2 * BLOCK, "0"), 16, 10).cast("double")).otherwise(F.octet_length(value).cast("double"))
        else:
            number = F.when(block == 0, F.shiftright(value.cast("bigint"), 32)).otherwise(value.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))).cast("double")
        return F.coalesce(-number, F.lit(LAST))

    def common(self, low: Column, high: Column, name: str) -> Column:
        """The block in which the texts between ``low`` and ``high`` first differ; for equal ones the number of blocks."""
        if not self.text[name]:
            return F.lit(0)
        a, b = F.encode(low, "utf-8"), F.encode(high, "utf-8")
        same = F.least(F.octet_length(low), F.octet_length(high))
        blocks = F.sequence(F.lit(0), F.floor(same / BLOCK).cast("int"))
        here = lambda x, k: F.substring(x, k * BLOCK + 1, F.lit(BLOCK))
        differing = F.filter(blocks, lambda k: here(a, k) != here(b, k))
        return F.when(low.isNull() | high.isNull(), 0).when(low == high, self.blocks[name]).otherwise(F.coalesce(F.get(differing, F.lit(0)), F.lit(self.blocks[name] - 1)))


def _ordered_bits(score: Column) -> Column:
    """The bits of a double as an integer of the same order."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), score + F.lit(0.0)).cast("bigint")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(2**63 - 1)))


def _with_bits(df: DataFrame, needed: Column) -> DataFrame:
    """``df`` with the ordered bits of its score where they are needed: Spark calls a method for them."""
    return df.withColumn("bits", F.when(needed, _ordered_bits(F.col("s"))))


def top_n_per_group(df: DataFrame, group: str, score: str, tie: str, item: str, n: int, fanout: int = 128) -> DataFrame:
    """Columns (group, item, score, tie) of the ``n`` best items of each group: score descending, tie ascending, item ascending.

    ``tie`` and ``item`` are strings or integers. Rows with a null or empty group, a null or NaN score or a null item
    are left out; infinite scores rank as such; -0.0 equals 0.0; a null tie comes after all others. Rows with the same
    group, item and tie are one item with its highest score. Groups of up to ``n`` items are returned whole, an empty
    table gives an empty result, and other columns of ``df`` are ignored, whatever their names. A group that holds
    more than a quarter of a partition's share of all rows is spread over several partitions by a hash of its items;
    their number is below four times the number of partitions, so the list of them is small enough to be sent to all.
    """
    if n < 1 or fanout < 2:
        raise ValueError("n must be at least 1 and fanout at least 2")
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    rows = df.select(F.col(group).alias("g"), F.col(score).cast("double").alias("s"), F.col(tie).alias("t"), F.col(item).alias("i"))
    rows = rows.where(F.col("g").isNotNull() & F.col("s").isNotNull() & ~F.isnan("s") & F.col("i").isNotNull())
    types = {f.name: f.dataType for f in rows.schema.fields}
    if isinstance(types["g"], T.StringType):
        rows = rows.where(F.col("g") != "")
    text = [c for c in ("t", "i") if isinstance(types[c], T.StringType)]

    finite = F.when(F.abs("s") != float("inf"), F.col("s"))
    counts = cut(rows.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.min(finite).alias("least"), F.max(finite).alias("most"), *[F.max(F.octet_length(c)).alias(f"len_{c}") for c in text]))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.min("least").alias("least"), F.max("most").alias("most"), *[F.max(f"len_{c}").alias(f"len_{c}") for c in text]).first()
    longest = {c: total[f"len_{c}"] or 0 for c in text}
    share = max(n, total["c"] / (4 * parts))
    hot = counts.where(F.col("c") > share).select("g", F.least(F.ceil(F.col("c") / F.lit(share)), F.lit(4 * parts)).cast("int").alias("salts"))

    salted = rows.join(F.broadcast(hot), "g", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("i").cast("bigint"), F.col("salts")).cast("int"), F.lit(0)))
    salted = salted.select("g", "salt", "i", "t", (F.col("s") + F.lit(0.0)).alias("s"))
    base = cut(salted.repartition(parts, "g", "salt").groupBy("g", "salt", "i", "t").agg(F.max("s").alias("s")))

    def to_rows(state: DataFrame) -> DataFrame:
        """A group's state, once for each part of a hot group, partitioned as the rows are."""
        spread = state.join(F.broadcast(hot), "g", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        return spread.drop("salts").repartition(parts, "g", "salt")

    code = _Code(types, {c: longest.get(c, 0) for c in ("t", "i")}, total["least"] or 0.0, total["most"] or 0.0)
    none = F.array().cast("array<double>")
    first = base.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.min(code.step()).alias("mn"), F.max(code.step()).alias("mx"))
    first = cut(first.select(
        "g", "c", F.lit(n).cast("bigint").alias("need"), F.lit(-1).alias("at"), F.lit(0.0).alias("above"), F.lit(0.0).alias("below"), none.alias("prefix"), F.lit(0).alias("lvl"), F.col("mn").alias("lo"), F.col("mx").alias("hi")))
    done = [first.where(F.col("c") <= n).select("g", none.alias("prefix"))]
    state = first.where(F.col("c") > n).drop("c")
    active, open_groups, rounds = base, state.count(), 0
    while open_groups:
        joined = active.select("g", "salt", "t", "i", "s").join(to_rows(state.drop("prefix")).hint("merge"), ["g", "salt"])
        joined = _with_bits(joined, F.col("at").isin(1, 2) | F.col("lvl").isin(1, 2))
        kept = joined.where((F.col("at") < 0) | code.part(F.col("at")).between(F.col("above"), F.col("below"))).select("g", "salt", "t", "i", "s", "bits", "lvl", "lo", "hi")
        active = cut(kept) if rounds else kept
        rounds += 1
        valued = active.withColumn("here", code.part(F.col("lvl")))
        width = F.col("hi") - F.col("lo")
        part = F.when(width <= 0, 0).otherwise(F.least(F.floor((F.col("here") - F.col("lo")) / width * fanout), F.lit(fanout - 1))).cast("int")
        counted = valued.withColumn("part", part).groupBy("g", "part").agg(
            F.count(F.lit(1)).alias("c"), F.min("here").alias("mn"), F.max("here").alias("mx"), F.min("s").alias("mn_s"), F.max("s").alias("mx_s"),
            # the texts are looked at only where the scores no longer differ
            *[f(F.when(F.col("lvl") >= 2, F.col(c))).alias(f"{name}_{c}") for c in ("t", "i") for name, f in (("mn", F.min), ("mx", F.max))], F.count("t").alias("with_t"))
        down = Window.partitionBy("g").orderBy(F.desc("part"))
        above = counted.withColumn("cum", F.sum("c").over(down)).where(F.col("cum") > 0).join(state.select("g", "prefix", "lvl", "need"), "g")
        cutoff = above.where((F.col("cum") >= F.col("need")) & (F.col("cum") - F.col("c") < F.col("need"))).withColumn("need", F.col("need") - F.col("cum") + F.col("c"))
        one = F.col("mn") == F.col("mx")
        # an interval of one value: on to the next part in which the remaining rows differ; what they share is filled in
        in_tie, tie_from = F.col("lvl") < code.item - 1, F.greatest(F.col("lvl") + 1, F.lit(code.tie))
        all_t = (F.col("with_t") == F.col("c")) | (F.col("with_t") == 0)
        to_tie = F.when(all_t, F.greatest(tie_from, code.tie + F.when(F.col("with_t") == 0, code.blocks["t"]).otherwise(code.common(F.col("mn_t"), F.col("mx_t"), "t")))).otherwise(tie_from)
        to_item = F.greatest(F.col("lvl") + 1, F.lit(code.item), code.item + code.common(F.col("mn_i"), F.col("mx_i"), "i"))
        equal = (F.col("lvl") == 0) & (F.col("mn_s") == F.col("mx_s"))
        following = F.when(equal, 2).when(F.col("lvl") < 2, F.col("lvl") + 1).when(in_tie & (to_tie < code.item), to_tie).otherwise(to_item).cast("int")
        cutoff = cutoff.withColumn("to", F.least(following, F.lit(code.size)))
        cutoff = _with_bits(cutoff.withColumn("s", F.col("mn_s")), one & (F.col("to") <= code.tie)).withColumn("least_bits", F.col("bits"))
        cutoff = _with_bits(cutoff.withColumn("s", F.col("mx_s")), one & (F.col("to") <= code.tie)).withColumn("most_bits", F.col("bits"))
        shared = F.when(F.col("to") > F.col("lvl") + 1, F.transform(F.sequence(F.col("lvl") + 1, F.col("to") - 1), lambda k: code.part(k, F.col("mn_t"), F.col("mn_i")))).otherwise(none)
        # the texts themselves bound the part that follows
        cutoff = cutoff.withColumn("shared", shared)
        bits = lambda c: F.when(F.col("to") == 1, F.shiftright(c, 32).cast("double")).otherwise(F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)).cast("double"))
        mixed = (F.col("to") < code.item) & ~all_t
        least = F.when(mixed, LAST).otherwise(code.part(F.col("to"), F.col("mx_t"), F.col("mx_i")))
        most = F.when(mixed, 0.0).otherwise(code.part(F.col("to"), F.col("mn_t"), F.col("mn_i")))
        finished = (F.col("c") == F.col("need")) | (one & (F.col("to") >= code.size))
        last = F.concat("prefix", F.array("mn"))
        cutoff = cut(cutoff.select(
            "g", "need", finished.alias("finished"), F.col("lvl").alias("at"), F.col("mn").alias("above"), F.col("mx").alias("below"),
            F.when(finished, last).when(one, F.concat(last, "shared")).otherwise(F.col("prefix")).alias("prefix"), F.when(one, F.col("to")).otherwise(F.col("lvl")).alias("lvl"),
            F.when(one & (F.col("to") < code.tie), bits("least_bits")).when(one, least).otherwise(F.col("mn")).alias("lo"), F.when(one & (F.col("to") < code.tie), bits("most_bits")).when(one, most).otherwise(F.col("mx")).alias("hi")))
        done.append(cutoff.where("finished").select("g", "prefix"))
        state = cutoff.where(~F.col("finished")).drop("finished")
        open_groups = state.count()

    cutoffs = to_rows(reduce(DataFrame.unionByName, done)).hint("merge")

    bound = lambda k: F.get(F.col("prefix"), F.lit(k))
    size = F.size("prefix")
    top = code.step()
    reaches = F.when(size == 0, True).when(top != bound(0), top > bound(0)).when(size == 1, True)
    reaches = reaches.otherwise(F.transform(F.sequence(F.lit(1), size - 1), lambda k: code.part(k)) >= F.slice("prefix", F.lit(2), size - 1))
    best = _with_bits(base.join(cutoffs, ["g", "salt"]), (size > 1) & (top == bound(0))).where(reaches)
    return best.select(F.col("g").alias(group), F.col("i").alias(item), F.col("s").alias(score), F.col("t").alias(tie))
