"""Interleaving sources to target weights by Pfair scheduling.

A source of weight w out of W is a periodic task: its k-th block (from 0) is
released at slot floor(k W / w) and due by slot ceil((k + 1) W / w).  Running
the released block with the earliest deadline in each slot meets all deadlines,
so after t slots every source has had its share of them to within one block.
When a source runs out, the others go on in proportion to their weights: with
T(u) the slots that all sources have had when each had min(its blocks, w u), block
k is released at floor(T(k / w)) and due by ceil(T((k + 1) / w)), and the bound of
one block holds to the end.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import accumulate
from math import lcm

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ship import ship
from .common import broadcast_if, group_ranks, materialise, table

#: Slots of so many blocks of a source make a row of the plan.
RUN = 64


def pfair_period(weights: list[int]) -> list[int]:
    """The task that runs in each slot of one period of ``sum(weights)`` slots; deadlines' ties go to the lower index."""
    total = sum(weights)
    released: list[list[tuple[int, int]]] = [[] for _ in range(total)]
    for i, w in enumerate(weights):
        for k in range(w):
            released[k * total // w].append((-(-(k + 1) * total // w), i))
    ready: list[tuple[int, int]] = []
    order = []
    for now in released:
        for job in now:
            heapq.heappush(ready, job)
        order.append(heapq.heappop(ready)[1])
    return order


def schedule(blocks: list[int], weights: list[int]) -> list[tuple[int, int, int, int, int, list[int]]]:
    """Phases of the schedule of ``blocks[i]`` blocks of each lane i.

    Rows ``(lane, first block, end block, first slot of the phase, slots in a
    period, the lane's slots in a period)``: in that phase block ``first + j``
    runs in slot ``phase + j // w * period + slots[j % w]``.
    """
    left, done, start, plan = list(blocks), [0] * len(blocks), 0, []
    while active := [i for i, n in enumerate(left) if n]:
        order = pfair_period([weights[i] for i in active])
        slots: dict[int, list[int]] = {i: [] for i in active}
        for t, k in enumerate(order):
            slots[active[k]].append(t)
        period = len(order)
        end = min((left[i] - 1) // weights[i] * period + slots[i][(left[i] - 1) % weights[i]] + 1 for i in active)
        whole, part = divmod(end, period)
        for i in active:
            ran = whole * weights[i] + sum(t < part for t in slots[i])
            plan.append((i, done[i], done[i] + ran, start, period, slots[i]))
            done[i] += ran
            left[i] -= ran
        start += end
    return plan


def tempered(power: float = 0.7) -> Callable[[dict[str, int]], dict[str, float]]:
    """Target weights that flatten sizes: each source's number of rows to a power."""
    return lambda sizes: {name: n**power for name, n in sizes.items()}


def exact(weights: list[float]) -> list[int]:
    """Integers in exactly the proportions of the weights; one of nothing is so small that its source comes last."""
    parts = [Fraction(w) for w in weights]
    least = min((w for w in parts if w > 0), default=Fraction(1))
    parts = [w if w > 0 else least / 2**60 for w in parts]
    whole = lcm(*{w.denominator for w in parts})
    return [int(w * whole) for w in parts]


def slots_of(blocks: list[int], weights: list[int]) -> Iterator[tuple[int, int]]:
    """``(source, block)`` of each slot from 0: the released block with the earliest deadline, all in exact integers."""
    ends = sorted((i for i, n in enumerate(blocks) if n), key=lambda i: Fraction(blocks[i], weights[i]))
    at = [blocks[i] / weights[i] for i in ends]
    over = [0, *accumulate(blocks[i] for i in ends)]
    rest = [0, *accumulate(weights[i] for i in reversed(ends))][::-1]

    def lines(k: int, w: int) -> range:
        """T is the least of lines over[m] + u rest[m]; those that may be it at u = k / w."""
        m = bisect_left(at, k / w)
        return range(max(0, m - 1), min(len(at), m + 1) + 1)

    def release(i: int, k: int) -> int:
        w = weights[i]
        return min(over[m] + k * rest[m] // w for m in lines(k, w))

    def deadline(i: int, k: int) -> int:
        w = weights[i]
        return min(over[m] - (-(k + 1) * rest[m] // w) for m in lines(k + 1, w))

    waiting = [(0, i, 0) for i in sorted(ends)]
    ready: list[tuple[int, int, int]] = []
    for now in range(over[-1]):
        while waiting and waiting[0][0] <= now:
            _, i, k = waiting[0]
            heapq.heappush(ready, (deadline(i, k), i, k))
            if k + 1 < blocks[i]:
                heapq.heapreplace(waiting, (release(i, k + 1), i, k + 1))
            else:
                heapq.heappop(waiting)
        _, i, k = heapq.heappop(ready)
        yield i, k


def slot_table(spark: SparkSession, lanes: list[str], blocks: list[int], weights: list[int]) -> DataFrame:
    """``_lane, _run, _slots``: slots of blocks ``RUN * _run`` and up of each source."""
    ship(spark)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("_lane", pa.string()), ("_run", pa.int64()), ("_slots", pa.list_(pa.int64()))])
        for _ in batches:
            slots: dict[int, list[int]] = {}
            rows: list[tuple[str, int, list[int]]] = []
            for t, (i, k) in enumerate(slots_of(blocks, weights)):
                slots.setdefault(i, []).append(t)
                if k % RUN == RUN - 1 or k + 1 == blocks[i]:
                    rows.append((lanes[i], k // RUN, slots.pop(i)))
                if len(rows) == 2048:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    return materialise(spark.range(0, 1, 1, 1).mapInArrow(plan, "_lane string, _run long, _slots array<long>"), "mixing-plan")


def mix(
    docs: DataFrame,
    weights: dict[str, float] | Callable[[dict[str, int]], dict[str, float]],
    block_rows: int = 16,
    seed: int = 23,
    piece_rows: int = 128,
) -> DataFrame:
    """Every row of ``docs`` with its ``block`` in its source, the block's ``slot`` and its ``position``.

    In order of ``position`` sources are interleaved to ``weights`` (by source,
    or a rule from numbers of rows; a source without one gets the least weight
    named), for as long as all of them last; no row is dropped or repeated.  A
    block is ``block_rows`` rows of a source in an order drawn by ``seed``.
    Positions are unique; a source's last block may be short and leaves a gap.

    A null source is a source of its own; null ids and texts are rows like
    others; rows alike in id and text are ordered at will.  An empty table gives
    no rows.  Columns named like the three new ones are replaced.

    Scale: sources may be of any size and number: ranks come from pieces of about
    ``piece_rows`` rows.  Each source's number of rows reaches the driver.  One
    task deals out the slots of all blocks, in time linear in their number.
    """
    carried = [c for c in docs.columns if c.lower() not in ("block", "slot", "position")]
    lane = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    found = docs.groupBy(lane.alias("_lane")).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = {r["_lane"]: r["n"] for r in sorted(found, key=lambda r: r["_lane"])}
    lanes = list(rows)
    plain = {x: x[1:] if x[0] == "=" else x for x in lanes}
    wanted = weights({plain[x]: n for x, n in rows.items()}) if callable(weights) else weights
    least = min(wanted.values(), default=1.0)
    blocks = [-(-rows[x] // block_rows) for x in lanes]
    plan = slot_table(docs.sparkSession, lanes, blocks, exact([wanted.get(plain[x], least) for x in lanes]))
    pieces = max(1, -(-max(rows.values(), default=1) // piece_rows))
    key = F.coalesce(F.xxhash64(F.lit(seed), "doc_id"), F.lit(0))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "text")).otherwise(key)
    dealt = docs.select(*carried, lane.alias("_lane"), key.alias("_key"))
    dealt = dealt.withColumn("_piece", F.pmod(F.shiftrightunsigned("_key", 3), F.lit(pieces)))
    ranked = group_ranks(dealt, "_lane", "_piece", ["_key", "doc_id"])
    ranked = ranked.withColumn("block", F.floor(F.col("_rank") / block_rows))
    ranked = ranked.withColumn("_run", F.floor(F.col("block") / RUN))
    return (
        ranked.join(broadcast_if(plan), ["_lane", "_run"])
        .withColumn("slot", F.get("_slots", (F.col("block") % RUN).cast("int")))
        .select(*carried, "block", "slot", (F.col("slot") * block_rows + F.col("_rank") % block_rows).alias("position"))
    )


def in_order(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the rows, files and rows in them by position."""
    return mixed.repartitionByRange("position").sortWithinPartitions("position").select(*columns)


def written_order(docs: DataFrame) -> Column:
    """Where a row of a table that was written in order is in it: the number of its file, then its place in the file.

    Spark reads files in whatever order balances tasks, so the order is taken from
    the files' names.  A frame that wasn't read from files is in order as it is.
    """
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return F.monotonically_increasing_id()
    name = F.col("_metadata.file_name")
    number = F.coalesce(F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long"), F.lit(0))
    return number * (1 << 40) + F.col("_metadata.row_index")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, sources interleaved to weights that flatten their sizes (rows to the power 0.7)."""
    rows: Column | DataFrame = mix(table(spark, sf_dir, "documents"), tempered())
    return rows.select("doc_id", "source", "block", "slot", "position")
