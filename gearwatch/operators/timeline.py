"""Cutting machines into segments so that no window group grows without bound.

Most logs have many machines of modest size; a window partitioned by machine is
then the right plan and nothing here costs anything. A log may also hold a third
of its rows under one machine. Such machines are measured first (two small
aggregates with map-side combine) and cut into time segments of about
``group_rows`` rows, narrow where readings come in bursts. Operators work inside (machine, segment) and pass what the
next segment must know through a small per-segment table, so results are the
same as on the uncut machine.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gearwatch.functions.columns import instant, named
from gearwatch.options import LogOptions
from gearwatch.session import written

US = "_us"
SEG = "_seg"
MACHINE = "_machine"
KEY = "_key"
ROW = "_rn"
# Places for ties of one instant in the row key; sparse logs hold fewer by measurement.
TIE_SLOTS = 4096
# Machine key of rows without a machine, so that segment joins are plain equi joins.
NO_MACHINE = "\u0000"
# A machine is cut only beyond total/HOT_LIMIT rows, so at most this many are ever listed.
HOT_LIMIT = 50_000
# Windows per cell of the first count.
WINDOWS_PER_CELL = 64
# Rows of one task that sorts machines or segments, on average. A step may hold some kilobytes a row in
# its sorts, far more than the few bytes of shuffle by which Spark joins up tasks.
TASK_ROWS = 100_000
# Rows without an instant sort after all segments of their machine.
LAST_SEGMENT = 1 << 62


@dataclass
class Step:
    """What an operator does inside a segment, hands on to later ones, and makes of both.

    ``inside`` adds columns to the rows of a segment, which know their number ``ROW`` in it.
    ``summary`` are aggregates of these columns, the operator's part of the state of a segment;
    ``chain`` adds columns to the table of states, of which ``passed`` go to the rows. Where no
    machine is cut only ``inside`` and ``out`` are used.
    """

    inside: Callable[[DataFrame], DataFrame]
    out: list[Column]
    summary: list[Column] = field(default_factory=list)
    chain: Callable[[DataFrame], DataFrame] = lambda states: states
    passed: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Timeline:
    options: LogOptions
    axis: str | None
    max_rows: int
    max_dense: int
    span: tuple[int, int]
    hot: DataFrame | None
    # Machines that are cut or have many rows in a window; None when that is (nearly) all.
    crowded: list | None = None
    keyed: bool = False
    # Cells of hot machines that are cut further, level by level.
    cuts: tuple[DataFrame, ...] = ()
    # Small cells that belong to the segment of an earlier one.
    joined: DataFrame | None = None
    # All rows of the log, and its machines; 0 where they were not counted.
    rows: int = 0
    machines: int = 0
    # Names of the machines that are cut.
    cut: tuple = ()

    @classmethod
    def measure(cls, df: DataFrame, options: LogOptions, axis: str | None = None) -> "Timeline":
        """Measure ``df`` along its time column, or along another LONG column ``axis``."""
        m = named(options.machine)
        us = instant(df, axis or options.time)
        widest = max(w for _, w in options.windows_us)
        rows = df.select(m.alias("m"), us.alias("us"))
        # Cells of many windows first: they combine well on the map side even when a window
        # holds a row or two, and few rows in a wide cell prove few in each window.
        machines = _by_cell(rows, widest * WINDOWS_PER_CELL).groupBy("m").agg(
            F.sum("n").alias("n"),
            F.max("n").alias("dense"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
        )
        top = machines.agg(
            F.sum("n").alias("total"), F.max("n").alias("n"), F.max("dense").alias("dense"),
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("machines"),
        ).first()
        if top["total"] is None:
            return cls(options, axis, 0, 0, (0, 0), None)
        limit = max(options.group_rows, top["total"] // HOT_LIMIT)
        dense, crowded, few = top["dense"], set(), True
        if axis is None and dense > options.dense_rows:
            cells = _by_cell(rows, widest).groupBy("m").agg(F.max("n").alias("n"))
            full = F.col("n") > options.dense_rows
            found = cells.agg(F.max("n").alias("dense"), F.count_if(full).alias("full")).first()
            dense, few = found["dense"], found["full"] <= HOT_LIMIT and found["full"] < top["machines"]
            if few:
                crowded = {r["m"] for r in cells.filter(full).select("m").collect()}  # at most HOT_LIMIT rows
        hot, cuts, joined, cut = None, (), None, ()
        if top["n"] > limit:
            hot, cuts, joined = _cut(rows, machines.filter(F.col("n") > limit), limit)
            cut = tuple(r["_hot"] for r in hot.collect())
            crowded |= set(cut)
        listed = few and len(crowded) <= HOT_LIMIT and len(crowded) < top["machines"]
        span = (top["lo"] or 0, top["hi"] or 0)
        return cls(options, axis, top["n"], dense, span, hot, list(crowded) if listed else None, cuts=cuts, joined=joined, rows=top["total"], machines=top["machines"], cut=cut)

    @property
    def split(self) -> bool:
        return self.hot is not None

    @property
    def keys(self) -> list[Column]:
        return [F.col(MACHINE), F.col(SEG)] if self.split else [named(self.options.machine)]

    @property
    def sparse(self) -> bool:
        """Few rows per window, no machine to cut, and instants that fit the row key."""
        return self.fits and not self.split and self.max_dense <= min(self.options.dense_rows, TIE_SLOTS // 2)

    @property
    def fits(self) -> bool:
        return self.span[1] - self.span[0] < (1 << 62) // TIE_SLOTS

    def apart(self, df: DataFrame, machines: list) -> tuple[DataFrame, DataFrame, "Timeline"]:
        """Rows of some machines, which are crowded or cut, rows of the others, and the timeline of the others."""
        kind = df.schema[self.options.machine].dataType.simpleString()
        listed = df.sparkSession.createDataFrame([(m,) for m in machines], f"_crowded {kind}")
        listed = F.broadcast(listed)  # at most HOT_LIMIT rows
        same = named(self.options.machine).eqNullSafe(listed["_crowded"])
        gone = set(machines)
        crowded = None if self.crowded is None else [m for m in self.crowded if m not in gone]
        dense = min(self.max_dense, self.options.dense_rows) if crowded == [] else self.max_dense
        others = replace(self, hot=None, cuts=(), joined=None, cut=(), max_dense=dense, crowded=crowded)
        return df.join(listed, same, "left_semi"), df.join(listed, same, "left_anti"), others

    def attach(self, df: DataFrame) -> DataFrame:
        """Add the instant and, where machines are cut, the segment; once is enough for a chain."""
        if US in df.columns and (SEG in df.columns or not self.split):
            return df
        df = df.withColumn(US, instant(df, self.axis or self.options.time))
        if not self.split:
            return df
        hot = F.broadcast(self.hot)
        # A segment is named by where it starts; machines that are not cut have one segment, 0.
        machine = named(self.options.machine)
        joined = df.join(hot, machine.eqNullSafe(hot["_hot"]), "left")
        start = F.coalesce(_cell_start(F.col(US), F.col("_lo"), F.col("_width")), F.lit(LAST_SEGMENT))
        joined = joined.withColumn(SEG, F.when(F.col("_width").isNull(), F.lit(0).cast("long")).otherwise(start))
        joined = joined.drop("_hot", "_lo", "_width")
        for level in self.cuts:
            same = machine.eqNullSafe(level["_cut"]) & (F.col(SEG) == level["_cell"])
            joined = joined.join(F.broadcast(level), same, "left")
            inner = _cell_start(F.col(US), F.col(SEG), F.col("_narrow"))
            joined = joined.withColumn(SEG, F.coalesce(inner, F.col(SEG))).drop("_cut", "_cell", "_narrow")
        if self.joined is not None:
            same = machine.eqNullSafe(self.joined["_cut"]) & (F.col(SEG) == self.joined["_cell"])
            joined = joined.join(F.broadcast(self.joined), same, "left")
            joined = joined.withColumn(SEG, F.coalesce(F.col("_start"), F.col(SEG))).drop("_cut", "_cell", "_start")
        return joined.withColumn(MACHINE, F.coalesce(machine.cast("string"), F.lit(NO_MACHINE)))

    def dealt(self, df: DataFrame) -> DataFrame:
        """Rows by machine, or segment, in as many tasks as their number asks for.

        Below that Spark's own number is enough: it has a task for every core.
        """
        tasks = self._tasks(df)
        return df if self.keyed or not tasks else df.repartition(tasks, *self.keys)

    def together(self, df: DataFrame) -> DataFrame:
        """Rows by machine, in as many tasks as ``dealt`` makes; steps by machine and more do not move them again."""
        tasks, m = self._tasks(df), named(self.options.machine)
        return df.repartition(tasks, m) if tasks else df.repartition(m)

    def _tasks(self, df: DataFrame) -> int:
        """Tasks that the number of rows asks for; 0 where Spark's own number is enough."""
        tasks = math.ceil(self.rows / TASK_ROWS)
        return 0 if tasks <= df.sparkSession.sparkContext.defaultParallelism else tasks

    def with_key(self, df: DataFrame) -> tuple[DataFrame, "Timeline"]:
        """Adds one LONG that orders the rows of a machine by instant, then among ties.

        A chain of operators on a keyed log shares one sort by this key. For sparse logs.
        """
        columns = df.columns
        df = self.dealt(self.attach(df))
        by_instant = Window.partitionBy(*self.keys).orderBy(F.col(US).asc_nulls_last())
        tie = F.row_number().over(self.forward()) - F.rank().over(by_instant)
        # Rows without an instant come after all others.
        since = F.coalesce(F.col(US), F.lit(self.span[1] + 1)) - F.lit(self.span[0])
        key = since * TIE_SLOTS + tie
        return df.select(*map(named, columns), key.alias(KEY)), replace(self, keyed=True)

    def order(self) -> list[Column]:
        if self.keyed:
            return [F.col(KEY)]
        return [F.col(US), *[named(c) for c in self.options.order]]

    def ascending(self) -> list[Column]:
        """Time order; rows without an instant come last, as they do in the last segment."""
        first, *ties = self.order()
        return [first.asc_nulls_last(), *[c.asc() for c in ties]]

    def descending(self) -> list[Column]:
        first, *ties = self.order()
        return [first.desc_nulls_first(), *[c.desc() for c in ties]]

    def forward(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.ascending())

    def backward(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.descending())

    def by_instant_desc(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(F.col(US).desc())

    def run(self, df: DataFrame, steps: list[Step], columns: list[Column]) -> DataFrame:
        """``columns`` of ``df`` and what the steps make of its rows.

        The states of all steps are one aggregate over the rows, written as one line per segment,
        chained there, and joined to the rows once: rows are dealt out and sorted by segment once
        for the states and once for the result, however many steps there are.
        """
        rows = self.dealt(self.attach(df))
        rows = rows.withColumn(ROW, F.row_number().over(self.forward()).cast("long"))
        for step in steps:
            rows = step.inside(rows)
        if self.split:
            states = written(self.per_segment(rows, [a for step in steps for a in step.summary]), "segments")
            for step in steps:
                states = step.chain(states)
            rows = self.join_segments(rows, states.select("_m", "_s", *[c for step in steps for c in step.passed]))
        return rows.select(*columns, *[c for step in steps for c in step.out])

    @property
    def segments(self) -> int:
        """At most so many segments has a machine."""
        return 2 * self.max_rows // self.options.group_rows + 3 if self.split else 1

    def carry(self, df: DataFrame, summary: list[Column], passed: list[Column]) -> DataFrame:
        """Give each row what the other segments of its machine pass on.

        ``summary`` are aggregates per segment; ``passed`` are columns over the
        summary table, built with ``earlier()`` / ``later()`` windows. That table has
        one row per segment, not per reading, and is written.
        """
        table = written(self.per_segment(df, summary), "segments")
        return self.join_segments(df, table.select("_m", "_s", *passed))

    def per_segment(self, df: DataFrame, summary: list[Column]) -> DataFrame:
        return df.groupBy(F.col(MACHINE).alias("_m"), F.col(SEG).alias("_s")).agg(*summary)

    def join_segments(self, df: DataFrame, table: DataFrame) -> DataFrame:
        """Rows with the line of their segment; rows stay where the windows put them."""
        same = (F.col(MACHINE) == F.col("_m")) & (F.col(SEG) == F.col("_s"))
        return df.join(table, same, "left").drop("_m", "_s")

    @staticmethod
    def earlier() -> WindowSpec:
        return Window.partitionBy("_m").orderBy("_s")

    @staticmethod
    def later() -> WindowSpec:
        return Window.partitionBy("_m").orderBy(F.col("_s").desc())


def before_current(spec: WindowSpec, rows: int | None = None) -> WindowSpec:
    start = Window.unboundedPreceding if rows is None else -rows
    return spec.rowsBetween(start, -1)


def up_to_current(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _by_cell(rows: DataFrame, width: int) -> DataFrame:
    return rows.groupBy("m", F.floor(F.col("us") / F.lit(width)).alias("cell")).agg(
        F.count("*").alias("n"), F.min("us").alias("lo"), F.max("us").alias("hi")
    )


def _cell_start(us: Column, start: Column, width: Column) -> Column:
    """Start of the cell of a width that holds ``us``, in whole numbers."""
    return start + F.call_function("div", us - start, width) * width


def _cut(rows: DataFrame, hot: DataFrame, limit: int) -> tuple[DataFrame, tuple[DataFrame, ...], DataFrame | None]:
    """Cells of hot machines, per level the cells that are cut further, and small cells to join up.

    First cells of equal width that would each hold ``limit`` rows of an even log; a cell with
    more than twice as many is cut again by its own row count, and so on. So a burst gets narrow
    cells and the rest of the machine wide ones. Small neighbours then join up, so that any two
    segments side by side exceed the limit: there are at most 2 * rows / limit + 1 per machine,
    however unevenly rows are spread. Rows of one instant always stay together. Only counts
    of cells reach the driver.
    """
    spark = rows.sparkSession
    found = hot.select("m", "lo", "hi", "n").collect()  # at most HOT_LIMIT rows
    kind = rows.schema["m"].dataType.simpleString()
    first = [
        (r["m"], r["lo"] or 0, max(1, math.ceil(((r["hi"] or 0) - (r["lo"] or 0) + 1) * limit / r["n"])))
        for r in found
    ]
    listing = spark.createDataFrame(first, f"_hot {kind}, _lo long, _width long")
    placed = rows.filter(F.col("us").isNotNull()).join(F.broadcast(listing), F.col("m").eqNullSafe(F.col("_hot")))
    placed = placed.select("m", "us", _cell_start(F.col("us"), F.col("_lo"), F.col("_width")).alias("cell"), "_width")
    levels: list[DataFrame] = []
    leaves: dict = {}
    while True:
        counted = placed.groupBy("m", "cell", "_width").agg(F.count("*").alias("n")).collect()
        full = [r for r in counted if r["n"] > 2 * limit and r["_width"] > 1]
        for r in counted:
            if r["n"] <= 2 * limit or r["_width"] == 1:
                leaves.setdefault(r["m"], []).append((r["cell"], r["n"]))
        if not full:
            return listing, tuple(levels), _joined_up(spark, leaves, limit, kind)
        narrower = [(r["m"], r["cell"], max(1, math.ceil(r["_width"] * limit / r["n"]))) for r in full]
        level = spark.createDataFrame(narrower, f"_cut {kind}, _cell long, _narrow long")
        levels.append(level)
        same = F.col("m").eqNullSafe(F.col("_cut")) & (F.col("cell") == F.col("_cell"))
        inner = _cell_start(F.col("us"), F.col("cell"), F.col("_narrow")).alias("cell")
        placed = placed.join(F.broadcast(level), same).select("m", "us", inner, F.col("_narrow").alias("_width"))


def _joined_up(spark, leaves: dict, limit: int, kind: str) -> DataFrame | None:
    """Where a cell's segment starts, for cells that follow others in their segment."""
    moved = []
    for machine, cells in leaves.items():
        start, held = None, limit
        for cell, n in sorted(cells):
            if start is not None and held + n <= limit:
                moved.append((machine, cell, start))
                held += n
            else:
                start, held = cell, n
    return spark.createDataFrame(moved, f"_cut {kind}, _cell long, _start long") if moved else None
