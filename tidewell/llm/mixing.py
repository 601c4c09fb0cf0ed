r"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

Sources, in order of code points (null last), weigh 5, 2, 1, 5, 2, 1, ... and share all
words of the corpus by weight. A target stops at `most` times the words its source has;
the excess is shared again by weight until none is above.

Among all document rates in [0, most] that give a source its target words, entropy
balancing takes the ones closest (in relative entropy) to one copy of each document.
These are exponentially tilted: `rate = min(most, exp(lambda * size / mean size))`, one
lambda for each source, the solution of the convex dual. Newton iterations find it,
kept inside a bracket that shrinks each time. They run on counts of documents per
(source, size), made by one aggregation; sums are decimals, so reruns agree exactly.

Rates become whole copies: running sums of rates over a source's sizes, largest first,
are rounded, so a source misses its target by less than its largest document; then one
size of each of 16 classes per doubling, largest first, makes up for what it can of that. Within a (source, size)
the copies are spread evenly, the odd ones to the documents of smallest hash, found by
counting hash buckets first, so no group of equal documents is ever ranked as a whole.

Defined cases: a null text has size 0; a document of size 0 is taken 0 times; a null
source is a source of its own; rows alike in id, text and source get the same number of
copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import checkpointed, col, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
#: Size classes per doubling of the size, in which one size makes up for a source's rounding.
CLASSES = 16
#: Documents of one (source, size) and hash bucket that are ranked together.
BUCKET = 500


@dataclass(frozen=True)
class Mix:
    documents: DataFrame  # id, key, size, first, second: one row per input row
    sources: DataFrame  # key, source, words, target
    plan: DataFrame  # key, size, least, odd_first, odd_second, rate


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """Sorts like the source, null last, and is never null."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def _numbered(df: DataFrame, column: str) -> DataFrame:
    """Adds `number`, from 0 in the order of a unique column: ranges first, so no task sorts all rows."""
    parts = checkpointed(df.repartitionByRange(8, column).withColumn("part", F.spark_partition_id()))
    before, offsets = 0, {}
    for part, n in sorted((r.part, r.n) for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect()):
        offsets[part], before = before, before + n
    if not offsets:
        return df.withColumn("number", F.lit(0).cast("long"))
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair]), F.col("part"))
    order = Window.partitionBy("part").orderBy(column)
    return parts.withColumn("number", (F.row_number().over(order) - 1 + offset).cast("long")).drop("part")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds weight and target to (key, words)."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")).cast("long")
    weighed = checkpointed(_numbered(sources, "key").withColumn("weight", weight).drop("number"))
    everything = weighed.agg(F.sum("words")).first()[0] or 0
    full, last = F.lit(False), None
    while True:  # each round can only add full sources; stops when none is added
        r = weighed.agg(F.sum(F.when(full, F.col("words") * most)).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("left")).first()
        rest, left = everything - (r.held or 0), r.left or 0
        if not left or (rest, left) == last:
            break
        last, share = (rest, left), F.col("weight") * F.lit(float(rest)) / F.lit(float(left))
        full = F.col("words") * most <= share
    target = (F.col("words") * most).cast("double")
    if left:
        target = F.when(full, target).otherwise(share)
    return weighed.select("key", "source", "words", target.alias("target"))


def tilt(cells: DataFrame, sources: DataFrame, most: int = MOST, accuracy: float = 1e-9, rounds: int = 60) -> DataFrame:
    """(key, tilt, mean) for sources with words: the Newton iterations. `cells` has key, size, n, size above 0.

    They run within one row per source, over the counts of its distinct sizes (fewer than the square root of twice
    its words), so they cost one job however many there are.
    """
    shape = cells.groupBy("key").agg(F.min("size").alias("least"), (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"),
                                     F.collect_list(F.struct("size", "n")).alias("sizes"))
    share = F.least(F.lit(float(most)), F.col("target") / F.col("words"))
    bound = F.log(share) * F.col("mean") / F.col("least")  # all documents at least / at most at this share
    begun = F.struct(F.lit(0.0).alias("tilt"), F.least(F.lit(0.0), bound).alias("low"), F.greatest(F.lit(0.0), bound).alias("high"),
                     (F.col("target") >= F.col("words") * most).alias("done"))
    exact = "decimal(38,6)"  # sums of decimals do not depend on the order
    nothing = F.struct(F.lit(0).cast(exact).alias("value"), F.lit(0).cast(exact).alias("slope"))

    def added(tilt: Column) -> Callable[[Column, Column], Column]:
        def add(acc: Column, cell: Column) -> Column:
            x = cell["size"] / F.col("mean")
            raw, words = F.exp(F.least(F.lit(50.0), tilt * x)), cell["n"] * cell["size"]
            value, slope = words * F.least(F.lit(float(most)), raw), F.when(raw < most, words * raw * x).otherwise(F.lit(0.0))
            return F.struct((acc["value"] + value.cast(exact)).cast(exact).alias("value"), (acc["slope"] + slope.cast(exact)).cast(exact).alias("slope"))

        return add

    def moved(state: Column, sums: Column) -> Column:
        value, slope = sums["value"].cast("double"), sums["slope"].cast("double")
        over = value - F.col("target")
        low, high = F.when(over < 0, state["tilt"]).otherwise(state["low"]), F.when(over > 0, state["tilt"]).otherwise(state["high"])
        step = state["tilt"] - over / F.when(slope > 0, slope)
        next = F.when((slope > 0) & (step > low) & (step < high), step).otherwise((low + high) / 2)
        met = F.abs(over) <= F.col("target") * accuracy
        return F.struct(F.when(met, state["tilt"]).otherwise(next).alias("tilt"), low.alias("low"), high.alias("high"), met.alias("done"))

    def one_round(state: Column, _: Column) -> Column:
        # Bound to a lambda variable, the sums are made once for all places that use them.
        sums = F.array(F.aggregate("sizes", nothing, added(state["tilt"])))
        return F.when(state["done"], state).otherwise(F.element_at(F.transform(sums, lambda s: moved(state, s)), 1))

    solved = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), begun, one_round)
    return checkpointed(sources.join(shape, "key").select("key", solved["tilt"].alias("tilt"), "mean"))


def copies(cells: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """(key, size, n, rate, copies): whole copies for all documents of a source and size together."""
    raw = F.exp(F.least(F.lit(50.0), F.col("tilt") * F.col("size") / F.col("mean")))
    rate = F.when(F.col("target") >= F.col("words") * most, F.lit(float(most))).otherwise(F.least(F.lit(float(most)), raw))
    rated = cells.join(tilt(cells, sources, most), "key").join(sources, "key").select("key", "size", "n", "target", rate.alias("rate"))
    mass = (F.col("n") * F.col("rate")).cast("decimal(38,9)")
    order = Window.partitionBy("key").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    summed = rated.withColumn("upto", F.sum(mass).over(order)).withColumn("own", mass)
    half = F.lit("0.5").cast("decimal(2,1)")
    whole = F.floor(F.col("upto") + half).cast("long") - F.floor(F.col("upto") - F.col("own") + half).cast("long")
    rounded = checkpointed(summed.select("key", "size", "n", "target", "rate", F.least(whole, F.col("n") * most).alias("copies")))

    largest = F.max_by(F.struct("size", "n", "copies"), F.struct("n", "size"))
    spare = rounded.groupBy("key", F.floor(F.log2("size") * CLASSES).alias("class")).agg(
        largest.alias("cell"), F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"))
    by_source = spare.groupBy("key").agg(F.sort_array(F.collect_list("cell"), asc=False).alias("cells"),
                                         (F.first("target") - F.sum("taken")).alias("missing"))
    empty = F.struct(F.col("missing").alias("missing"), F.array().cast("array<struct<size:bigint,more:bigint>>").alias("changes"))

    def fitted(acc: Column, cell: Column) -> Column:
        wanted = (acc["missing"] / cell["size"]).cast("long")  # toward zero: never past the target
        more = F.greatest(-cell["copies"], F.least(cell["n"] * most - cell["copies"], wanted))
        return F.struct((acc["missing"] - more * cell["size"]).alias("missing"),
                        F.concat(acc["changes"], F.array(F.struct(cell["size"].alias("size"), more.alias("more")))).alias("changes"))

    changes = by_source.select("key", F.explode(F.aggregate("cells", empty, fitted)["changes"]).alias("c")).select("key", "c.size", "c.more")
    return rounded.join(changes, ["key", "size"], "left").select(
        "key", "size", "n", "rate", (F.col("copies") + F.coalesce("more", F.lit(0))).alias("copies"))


def _odd_ones(documents: DataFrame, shares: DataFrame) -> DataFrame:
    """(key, size, odd_first, odd_second): up to which hash the documents of a cell get one copy more."""
    place = lambda n: F.floor(F.col("first") / F.lit(float(1 << 62)) * F.ceil(F.col(n) / BUCKET)).cast("long")
    rows = documents.join(shares.where("odd > 0"), ["key", "size"]).select("key", "size", "first", "second", "odd", place("n").alias("bucket"))
    counts = rows.groupBy("key", "size", "bucket").agg(F.count("*").alias("held"), F.first("odd").alias("odd"))
    order = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    border = (counts.withColumn("before", F.sum("held").over(order) - F.col("held"))
              .where("before < odd and odd <= before + held").select("key", "size", "bucket", (F.col("odd") - F.col("before")).alias("nth")))
    ranked = rows.join(border, ["key", "size", "bucket"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("first", "second")))
    return ranked.where("rank = nth").select("key", "size", F.col("first").alias("odd_first"), F.col("second").alias("odd_second"))


def _hashes(id: Column, text: Column) -> list[Column]:
    return [F.shiftrightunsigned(F.xxhash64(id.cast("string"), F.lit(7)), 2).alias("first"), F.xxhash64(text).alias("second")]


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST,
        id: str = "doc_id", text: str = "text", source: str = "source") -> Mix:
    documents = staged(docs.select(col(id).alias("id"), col(source).cast("string").alias("source"), _key(col(source)).alias("key"),
                                   size_of(col(text)).alias("size"), *_hashes(col(id), col(text))))
    counted = documents.groupBy("key", "source", "size").agg(F.count("*").alias("n"))
    by_size = checkpointed(counted)
    sources = checkpointed(targets(by_size.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("words")), weights, most))
    cells = by_size.where("size > 0").select("key", "size", "n")
    even = F.floor(F.col("copies") / F.col("n")).cast("long")
    shares = checkpointed(copies(cells, sources, most).select("key", "size", "n", "rate", even.alias("least"),
                                                              (F.col("copies") - even * F.col("n")).alias("odd")))
    plan = checkpointed(shares.join(_odd_ones(documents, shares), ["key", "size"], "left")
                        .select("key", "size", "least", "odd_first", "odd_second", "rate"))
    return Mix(documents, sources, plan)


def _copies() -> Column:
    odd = (F.col("first") < F.col("odd_first")) | ((F.col("first") == F.col("odd_first")) & (F.col("second") <= F.col("odd_second")))
    return F.coalesce(F.col("least") + F.when(odd, 1).otherwise(0), F.lit(0)).cast("long")


def taken(mixed: Mix, id: str = "doc_id") -> DataFrame:
    """One row per input row: id, size, source_size, target, rate, copies, taken."""
    rows = mixed.documents.join(mixed.sources.select("key", F.col("words").alias("source_size"), "target"), "key")
    rows = rows.join(mixed.plan, ["key", "size"], "left").withColumn("copies", _copies())
    return rows.select(F.col("id").alias(id), "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, mixed: Mix, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of the mix, all columns, each as often as it is taken."""
    rows = docs.select(F.struct("*").alias("row"), _key(col(source)).alias("key"), size_of(col(text)).alias("size"), *_hashes(col(id), col(text)))
    rows = rows.join(mixed.plan, ["key", "size"]).select("row", _copies().alias("copies")).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])
