"""Operator 13: mixing sources to target weights, by cube-method balanced sampling.

Sources in the order of their names take the ``WEIGHTS`` in turn and share ``SHARE`` times all words by
them; no target goes beyond ``LIMIT`` times its source's words, what is over is shared again
among the others.  A source whose target is r times its words takes floor(r) copies of each
document, and one more of some: every document's chance of it is r - floor(r), and the choice
is balanced on the number of documents and of words.

1. Flight: of three documents with open chances, a move that changes neither the sum of
   chances nor the sum of chance x words always exists.  It goes, by a coin whose sides
   balance the moves, until one chance is 0 or 1; then the next document steps in.  A
   task does so along its sorted rows, with three documents in hand, for blocks of a source.
2. At most two open documents of each block remain, and the ``RESERVE`` of all sizes that the flight leaves out.  They
   are a table again, hundreds of times smaller, and meet in new blocks of their source, until
   every source has one block.
3. Landing: the last ones of a source are settled in the way whose words miss their expected sum least.

Coins are hashes of the document, and documents come in the order of their sizes and hashes, so reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own, the last; documents of size
0 take part by their number and take no words; a source without words has target 0; repeated rows, and rows with null
ids, are documents of their own, of which equal ones take as many copies in all whichever of them do; an empty table
gives no rows.  Columns go but those asked for; names that these have get an underscore.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
LIMIT = 2
SEED = 13
#: Documents of a block of a flight.
BLOCK = 10_000
#: A chance so near to 0 or 1 is settled (rounding of the moves).
SETTLED = 1e-9
#: Documents kept for the landing.
RESERVE = 12
#: Parts of a group of equal documents.
SALTS = 64


def size_of(text: Column) -> Column:
    """The number of runs of other than ASCII blanks; one character is left of each run, whatever its length."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marks, " \t\n\x0b\f\r", "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, limit: int = LIMIT) -> DataFrame:
    """(s, source, source_size, target) of (source, source_size), one row per source; s numbers them.

    The order of names is that of ranges, sorted, and of places in them; the driver sees the ranges' sizes and
    three sums a round, in which more sources reach the limit.
    """
    spark = sizes.sparkSession
    order = F.col("source").asc_nulls_last()
    placed = sizes.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id())
    placed = common.stored(placed, "mix-sources")
    in_range = F.shiftright("at", 33).cast("int").alias("range")
    counts = {r["range"]: r["n"] for r in placed.groupBy(in_range).agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for k in sorted(counts):
        starts.append((k, total % len(weights)))
        total += counts[k]
    start = spark.createDataFrame(starts, "range int, start int")
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.get(F.array(*map(F.lit, weights)), (rank % len(weights)).cast("int")).cast("long")
    placed = placed.join(start, F.shiftright("at", 33).cast("int") == F.col("range")).select(F.col("at").alias("s"), "source", "source_size", weight.alias("weight"))
    placed = common.stored(placed, "mix-weights")

    top = F.col("source_size") * limit
    wanted = int(placed.agg(F.sum(F.col("source_size").cast("decimal(38,0)"))).first()[0] or 0) * share
    level = Fraction(0)
    over = F.lit(False)
    for _ in itertools.count():
        capped, free = placed.agg(F.coalesce(F.sum(F.when(over, top.cast("decimal(38,0)"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if not free:
            break
        above = Fraction(wanted - int(capped)) / int(free)
        if above <= level:
            break
        level = above
        # level * weight > top, on whole numbers
        n, d = level.as_integer_ratio()
        over = F.col("weight").cast("decimal(19,0)") * F.lit(n).cast("decimal(19,0)") > top.cast("decimal(19,0)") * F.lit(d).cast("decimal(19,0)")
    open_target = F.col("weight") * F.lit(level.numerator).cast("double") / F.lit(level.denominator).cast("double")
    return placed.select("s", "source", "source_size", F.when(over, top.cast("double")).otherwise(open_target).alias("target"))


def _coin(x: int) -> float:
    """splitmix64 as a number below 1."""
    x = (x + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 31)) >> 11) / float(1 << 53)


def move(sizes: list[int], chances: list[float], coin: float) -> list[float]:
    """Three chances after one step along the vector that keeps their sum and their sum by size: one at least is 0 or 1."""
    a, b, c = sizes
    way = (c - b, a - c, b - a)
    if not any(way):
        way = (1, -1, 0)
    scale = max(map(abs, way))
    way = tuple(w / scale for w in way)
    up = min((1 - p) / w if w > 0 else p / -w for p, w in zip(chances, way, strict=True) if w)
    down = min(p / w if w > 0 else (1 - p) / -w for p, w in zip(chances, way, strict=True) if w)
    step = up if coin * (up + down) < down else -down
    moved = [p + step * w for p, w in zip(chances, way, strict=True)]
    return [0.0 if p < SETTLED else 1.0 if p > 1 - SETTLED else p for p in moved]


def landed(sizes: list[int], chances: list[float]) -> list[float]:
    """The way to settle a few documents whose words miss their expected sum least; ties by the number of documents, then by their order."""
    ways = (np.arange(1 << len(sizes))[:, None] >> np.arange(len(sizes))) & 1
    miss = np.abs(ways @ np.array(sizes, float) - np.dot(sizes, chances))
    count = np.abs(ways.sum(axis=1) - sum(chances))
    return ways[np.lexsort((count, miss.round(6)))[0]].astype(float).tolist()


def flown(rows: Iterator[tuple[int, int, float]], last: bool) -> Iterator[tuple[int, int, float]]:
    """(u, size, chance) after the flight over the open documents of one block, in their order; ``last`` settles all."""
    whole = list(rows)
    reserved = RESERVE if last else min(RESERVE, len(whole) // 4)
    step = max(1, len(whole) // max(1, reserved))
    reserve = set(range(step // 2, len(whole), step)[:reserved])
    rows = (r for k, r in enumerate(whole) if k not in reserve)
    held: list[list] = []
    for turn, (u, size, chance) in enumerate(rows):
        held.append([u, size, chance])
        if len(held) < 3:
            continue
        for h, p in zip(held, move([h[1] for h in held], [h[2] for h in held], _coin(u ^ (turn << 20) ^ SEED)), strict=True):
            h[2] = p
        yield from (tuple(h) for h in held if h[2] in (0.0, 1.0))
        held = [h for h in held if h[2] not in (0.0, 1.0)]
    held += [list(whole[k]) for k in sorted(reserve)]
    if last:
        for h, p in zip(held, landed([h[1] for h in held], [h[2] for h in held]) if held else [], strict=True):
            h[2] = p
    yield from map(tuple, held)


def _flight(units: DataFrame, last: bool) -> DataFrame:
    """(s, u, size, chance) of (s, block, u, nth, size, chance), after a flight in each block."""
    task = ["s", "block"]
    columns = [*task, "u", "size", "chance"]
    kinds = pa.int64(), pa.int64(), pa.int64(), pa.float64()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in common.slices(batches, 4_096):
            yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ((s, *unit) for (s, _), block in itertools.groupby(rows(batches), key=lambda r: r[:2]) for unit in flown((r[2:] for r in block), last))
        while some := list(itertools.islice(made, 4_096)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], ["s", "u", "size", "chance"])

    units = units.repartition(*task).sortWithinPartitions(*task, F.desc("size"), "u", "nth")
    return units.select(columns).mapInArrow(run, "s long, u long, size long, chance double")


def choose(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """(s, u, size, more) of (s, u, size, n, chance): how many of the n equal documents (s, u, size) are chosen, each with that
    chance and balanced within each s; none are no row."""
    common.workers_see_package(units.sparkSession)
    # Equal documents one by one, a thousand at a time.
    zero = F.lit(0).cast("long")
    parts = F.explode(F.sequence(zero, F.floor((F.col("n") - 1) / 1_000).cast("long")))
    units = units.withColumn("part", parts).withColumn("nth", F.explode(F.sequence(zero, F.least(F.lit(999).cast("long"), F.col("n") - 1 - F.col("part") * 1_000))))
    units = units.select("s", "u", (F.col("part") * 1_000 + F.col("nth")).alias("nth"), "size", "chance")
    settled = []
    for level in itertools.count():
        sizes = common.stored(units.groupBy("s").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "mix-blocks")
        last = sizes.filter("blocks > 1").isEmpty()
        dealt = units.join(sizes, "s").withColumn("block", F.pmod(F.xxhash64("u", "nth", F.lit(level)), F.col("blocks")).cast("int"))
        flight = common.stored(_flight(dealt, last), "mix-flight")
        settled.append(flight.filter("chance = 1"))
        if last:
            break
        open_ones = flight.filter((F.col("chance") > 0) & (F.col("chance") < 1))
        nth = F.row_number().over(Window.partitionBy("s", "u", "size").orderBy("chance"))
        units = common.stored(open_ones.withColumn("nth", nth), "mix-open")
    chosen = settled[0]
    for more in settled[1:]:
        chosen = chosen.unionByName(more)
    return chosen.groupBy("s", "u", "size").agg(F.count("*").alias("more"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        share: Fraction = SHARE, limit: int = LIMIT, block: int = BLOCK, keep: list[str] | None = None) -> DataFrame:
    """Every row's ``keep`` columns (the id by default) with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` = copies x size."""
    keep = [id_col] if keep is None else keep
    into = [common.fresh(docs.select(*keep), c) for c in ("size", "source_size", "target", "copies", "taken")]
    made = docs.select(F.struct(*keep).alias("row"), F.col(source_col).cast("string").alias("source"), size_of(F.col(text_col)).alias("size"),
                       F.xxhash64(F.lit(SEED), id_col, text_col).alias("u"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt"))
    made = common.stored(made, "mix-sizes")
    goals = targets(made.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + SETTLED)
    goals = common.stored(goals.select("s", F.col("source").alias("of"), "source_size", "target", whole.alias("whole"), (ratio - whole).alias("chance")), "mix-targets")
    sized = common.stored(made.join(goals, made["source"].eqNullSafe(goals["of"])).drop("source", "of"), "mix-sized")

    same = ["s", "u", "size"]
    units = sized.filter(F.col("chance") > SETTLED).groupBy(*same).agg(F.count("*").alias("n"), F.first("chance").alias("chance"))
    chosen = choose(units, block)
    # Of equal documents the first of each salt take the copies left by the salts before.
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*same).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    salts = sized.groupBy(*same, "salt").agg(F.count("*").alias("n")).join(chosen, same).select(*same, "salt", (F.col("more") - before).alias("left"))
    nth = F.row_number().over(Window.partitionBy(*same, "salt").orderBy("whole"))
    out = sized.join(salts, [*same, "salt"], "left").withColumn("copies", F.col("whole") + F.when(nth <= F.col("left"), 1).otherwise(0))
    return out.select("row.*", F.col("size").alias(into[0]), F.col("source_size").alias(into[1]), F.col("target").alias(into[2]),
                      F.col("copies").alias(into[3]), (F.col("copies") * F.col("size")).alias(into[4]))
