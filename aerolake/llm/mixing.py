"""Mixing sources to target weights by a Pfair schedule.

The documents of a source are cut into blocks of ``block`` characters in the order of the table.
Block j of a source with weight w is released at floor((j - 1) / w) and due at ceil(j / w), and
slots go to the released block with the earliest deadline, so that at any slot each source is less
than one block away from its share. Weights are whole parts of a period; the schedule of a period
repeats, so only one period is simulated, for each set of sources that still have blocks: when a
source ends, the others go on with their weights in proportion.

A schedule has at most ``ENTRIES`` entries, and only these and their periods are on the driver. Where
there are more sources, the largest are entries of their own and the others are dealt into groups of
about ``GROUP`` sources. A group is one entry with the summed weight, and its slots are dealt to the
blocks of its sources by a schedule of its own, made in a task. Where there are too many groups as well,
they are sources of a next level, so every source of any number has its own place in a schedule. On
each level a source, or the group it is in, is less than one block away from its share of what is above it. When
a source ends, its part goes to the others of its group first. Every document is placed once; none is
dropped or repeated.

Defined results: null text counts as one character, as does an empty one; a null source is the
source with an empty name; repeated rows are placed each; sources without a given weight share
the smallest given one. Other columns are ignored. An empty table gives an empty schedule.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches
from aerolake.plans.tables import stage

ENTRIES = 512
SHARED = 64  # entries that groups have, at least
GROUP = 256  # sources of a group, about
PERIOD = 4096
BLOCK = 100_000
_ROWS = 50_000  # of a batch that goes back to Spark
_PLACES = "node string, block bigint, entry string, at bigint"


def whole_parts(weights: dict[str, float], period: int) -> dict[str, int]:
    """Parts of the period by largest remainder, at least one each."""
    names = sorted(weights)
    total = sum(weights.values())
    free = period - len(names)
    exact = {n: weights[n] / total * free for n in names}
    parts = {n: 1 + int(exact[n]) for n in names}
    left = period - sum(parts.values())
    for name in sorted(names, key=lambda n: (int(exact[n]) - exact[n], n))[:left]:
        parts[name] += 1
    return parts


def slots_in_turn(parts: dict[str, int]) -> Iterator[str]:
    """The source of each slot of a period: earliest deadline first among released blocks."""
    period = sum(parts.values())
    waiting = [(0, name, 1) for name in sorted(parts)]  # (release, source, block)
    ready: list[tuple[int, str, int]] = []  # (deadline, source, block)
    heapq.heapify(waiting)
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, name, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-block * period // parts[name]), name, block))
        _, name, block = heapq.heappop(ready)
        yield name
        if block < parts[name]:
            heapq.heappush(waiting, (block * period // parts[name], name, block + 1))


def one_period(parts: dict[str, int]) -> list[str]:
    """The source of each slot of a period."""
    return list(slots_in_turn(parts))


@dataclass
class Phase:
    """A stretch of slots with one set of sources."""

    start: int  # its first slot
    period: int
    first: dict[str, int]  # the first block of each source
    slots: dict[str, np.ndarray]  # of a source's blocks within a period, up to the end of the phase


def schedule(blocks: dict[str, int], weights: dict[str, float], period: int) -> list[Phase]:
    """Phases for sources with so many blocks."""
    left = {n: b for n, b in blocks.items() if b}
    done = dict.fromkeys(left, 0)
    start, phases = 0, []
    while left:
        size = max(period, 2 * len(left))
        parts = whole_parts({n: weights[n] for n in left}, size)
        taken: dict[str, list[int]] = {n: [] for n in parts}
        ended = False
        for slot, name in enumerate(slots_in_turn(parts)):
            taken[name].append(slot)
            if len(taken[name]) == left[name]:
                ended = True
                break
        slots = {n: np.array(own, np.int64) for n, own in taken.items()}
        phases.append(Phase(start, size, dict(done), slots))
        # the phase ends with the slot of the first source's last block
        if ended:
            end = slot + 1
        else:
            ends = {n: (b - 1) // parts[n] * size + int(slots[n][(b - 1) % parts[n]]) for n, b in left.items()}
            end = min(ends.values()) + 1
        whole, rest = divmod(end, size)
        for name in list(left):
            used = whole * parts[name] + int(np.searchsorted(slots[name], rest))
            used = min(used, left[name])
            done[name] += used
            left[name] -= used
            if not left[name]:
                del left[name]
        start += end
    return phases


def slots_of(phases: list[Phase], name: str, blocks: np.ndarray) -> np.ndarray:
    """The slots of some blocks of a source."""
    own = [p for p in phases if name in p.slots]
    phase_of = np.searchsorted([p.first[name] for p in own], blocks, side="right") - 1
    slot = np.zeros(len(blocks), np.int64)
    for number in np.unique(phase_of):
        phase = own[number]
        rows = phase_of == number
        turn, place = np.divmod(blocks[rows] - phase.first[name], len(phase.slots[name]))
        slot[rows] = phase.start + turn * phase.period + phase.slots[name][place]
    return slot


def _slots(batches: Iterator[pa.RecordBatch], phases: list[Phase]):
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        blocks = columns.pop("_at").to_numpy(zero_copy_only=False)
        coded = columns.pop("_entry").dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        slot = np.zeros(len(blocks), np.int64)
        for code, name in enumerate(coded.dictionary.to_pylist()):
            mine = np.flatnonzero(which == code)
            slot[mine] = slots_of(phases, name, blocks[mine])
        yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(slot)], names=[*columns, "slot"])


def _in_groups(batches: Iterator[pa.RecordBatch], period: int):
    """The place of every block of every source of a group (``_PLACES``); rows come by group."""

    def places() -> Iterator[tuple[str, str, np.ndarray, np.ndarray]]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for group, own in groupby(rows, key=lambda row: row["group"]):
            members = list(own)
            weights = {m["node"]: m["weight"] for m in members}
            phases = schedule({m["node"]: m["blocks"] for m in members}, weights, period)
            for m in members:
                for at in range(0, m["blocks"], _ROWS):
                    blocks = np.arange(at, min(at + _ROWS, m["blocks"]))
                    yield m["node"], group, blocks, slots_of(phases, m["node"], blocks)

    held: list[tuple[str, str, np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        sizes = [len(blocks) for _, _, blocks, _ in held]
        nodes, groups = (np.repeat(np.array(x, object), sizes) for x in list(zip(*held))[:2])
        blocks, slots = (np.concatenate(x) for x in list(zip(*held))[2:])
        held.clear()
        return batch_of(
            {
                "node": (nodes, pa.string()),
                "block": (blocks, pa.int64()),
                "entry": (groups, pa.string()),
                "at": (slots, pa.int64()),
            }
        )

    size = 0
    for place in places():
        held.append(place)
        size += len(place[2])
        if size >= _ROWS:
            yield flush()
            size = 0
    if held:
        yield flush()


def entries_of(nodes: DataFrame, period: int) -> tuple[DataFrame, DataFrame | None]:
    """At most ``ENTRIES`` nodes (node, blocks, weight) in place of any number of them.

    With them the places (``_PLACES``) of the blocks of all given nodes that are in groups.
    """
    places, level = None, 0
    while (count := nodes.count()) > ENTRIES:
        own = nodes.orderBy(F.desc("blocks"), "node").limit(ENTRIES - SHARED)
        groups = max(SHARED, -(-(count - ENTRIES + SHARED) // GROUP))
        number = F.pmod(F.xxhash64("node"), F.lit(groups)).cast("string")
        rest = nodes.join(F.broadcast(own.select("node")), "node", "left_anti")
        rest = rest.withColumn("group", F.concat(F.lit(f"~{level}:"), number))
        dealt = rest.repartition("group").sortWithinPartitions("group", "node")
        inner = stage(in_batches(dealt, partial(_in_groups, period=period), _PLACES), "mixing-groups")
        if places is not None:
            above = inner.toDF("entry", "at", "_entry", "_at")
            entry, at = F.coalesce("_entry", "entry").alias("entry"), F.coalesce("_at", "at").alias("at")
            inner = (
                places.join(above, ["entry", "at"], "left").select("node", "block", entry, at)
                .unionByName(inner.filter(~F.col("node").startswith("~")))
            )
        places = inner
        together = rest.groupBy(F.col("group").alias("node"))
        together = together.agg(F.sum("blocks").alias("blocks"), F.sum("weight").alias("weight"))
        nodes = stage(own.unionByName(together), "mixing-nodes")
        level += 1
    return nodes, places


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block: int = BLOCK,
    period: int = PERIOD,
    temperature: float = 0.5,
) -> DataFrame:
    """doc_id, source, size, block, slot, place and row of every document.

    ``slot`` then ``place`` (characters of the source before the document) is the order of the
    mixture; ``row`` tells rows with equal values apart. Without ``weights`` a source weighs its
    size to the power of ``temperature``.
    """
    rows = stage(
        docs.select(
            "doc_id",
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
            F.greatest(F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(1))
            .cast("bigint").alias("size"),
            F.monotonically_increasing_id().alias("row"),
        ), "mixing",
    )
    return place(rows, weights, block, period, temperature)


def place(
    rows: DataFrame,
    weights: dict[str, float] | None,
    block: int,
    period: int,
    temperature: float,
) -> DataFrame:
    """``mix`` for stored rows with doc_id, source, size, row.

    Other columns stay, but for ``block``, ``place`` and ``slot``, which are results.
    """
    if weights and any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    totals = stage(rows.groupBy("source").agg(F.sum("size").alias("total")), "mixing-totals")
    weight = F.pow("total", F.lit(temperature))
    if weights:
        kind = "source string, weight double"
        given = rows.sparkSession.createDataFrame([(n, float(w)) for n, w in weights.items()], kind)
        totals = totals.join(given, "source", "left")
        weight = F.coalesce("weight", F.lit(float(min(weights.values()))))
    node = F.concat(F.lit("="), F.col("source"))
    blocks = F.ceil(F.col("total") / block).cast("bigint")
    nodes = stage(
        totals.select(node.alias("node"), blocks.alias("blocks"), weight.alias("weight")), "mixing-nodes"
    )
    nodes, places = entries_of(nodes, period)
    entries = nodes.collect()
    wanted = {r["node"]: r["weight"] for r in entries}
    phases = schedule({r["node"]: r["blocks"] for r in entries}, wanted, period)

    chunk = F.shiftright("row", 13)  # at most 8192 rows, in the order of the table
    cut = rows.drop("block", "place", "slot").withColumns({"_node": node, "_chunk": chunk})
    sums = cut.groupBy("_node", "_chunk").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("_node").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        sums.select("_node", "_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")),
        "mixing-starts",
    )
    within = (
        Window.partitionBy("_node", "_chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        cut.withColumn("_earlier", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(starts, ["_node", "_chunk"])
        .withColumn("place", F.col("_start") + F.col("_earlier"))
        .withColumn("block", F.floor(F.col("place") / block).cast("bigint"))
        .drop("_chunk", "_earlier", "_start")
    )
    if places is None:
        placed = placed.withColumnRenamed("_node", "_entry").withColumn("_at", F.col("block"))
    else:
        places = places.toDF("_node", "block", "_entry", "_at")
        placed = (
            placed.join(places, ["_node", "block"], "left")
            .withColumn("_entry", F.coalesce("_entry", "_node"))
            .withColumn("_at", F.coalesce("_at", "block"))
            .drop("_node")
        )
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields if f.name not in ("_entry", "_at")]
    return in_batches(placed, partial(_slots, phases=phases), f"{', '.join(kept)}, slot bigint")
