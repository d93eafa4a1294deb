"""Time-series features: lags, rolling windows, exponential averages, the pipeline.

All features look back only. Every operator takes an optional ``Timeline``; pass
one measured timeline through a chain so the log is measured once. Lags, averages and
the label are steps of one run: where machines are cut, one state per segment holds what
all of them hand on.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gearwatch.functions import moments as M
from gearwatch.functions.columns import instant, named
from gearwatch.operators.schema import sensor_columns
from gearwatch.operators.target import normalise_failure, target_step
from gearwatch.operators.timeline import (
    HOT_LIMIT,
    KEY,
    NO_MACHINE,
    ROW,
    TIE_SLOTS,
    Step,
    Timeline,
    before_current,
    up_to_current,
)
from gearwatch.options import LogOptions
from gearwatch.session import written

# exp(-VANISHED) times the largest double is zero in doubles, so a reading that decayed further
# than this adds nothing to an average, however large it is.
VANISHED = 1500.0
# Decay inside one block of a scaled sum; scales run from exp(-RANGE / 2) to exp(RANGE / 2).
RANGE = 600.0
# Factors of decay that one block length may serve.
SHARED = 8
# Rows of pane sums, about 140 bytes each, that may go to every executor.
BROADCAST_ROWS = 50_000
# Rows of a log whose pane sums may be dealt out by themselves; they take several times the bytes of the rows.
FEW_ROWS = 50_000


def create_lag_features(
    df: DataFrame,
    options: LogOptions,
    sensors: list[str] | None = None,
    timeline: Timeline | None = None,
) -> DataFrame:
    """``{sensor}_lag_{k}``: the reading k rows earlier on the same machine."""
    chosen = sensor_columns(df, options) if sensors is None else sensors
    t = timeline or Timeline.measure(df, options)
    return t.run(df, [lag_step(options, chosen, t)], [*map(named, df.columns)])


def lag_step(options: LogOptions, chosen: list[str], t: Timeline) -> Step:
    w = t.forward()
    pairs = [(i, c, k, f"{c}_lag_{k}") for i, c in enumerate(chosen) for k in options.lags]
    lags = [F.lag(named(c), k).over(w).alias(f"_lag{i}_{k}") for i, c, k, _ in pairs]
    if not t.split:
        return Step(lambda rows: rows.select("*", *lags), [F.col(f"_lag{i}_{k}").alias(name) for i, _, k, name in pairs])

    # Segments hand on their last rows, newest first.
    depth = max(options.lags, default=1)

    def row(back: int) -> Column:
        return F.struct(
            *[(F.lag(named(c), back).over(w) if back else named(c)).alias(f"x{i}") for i, c in enumerate(chosen)]
        )

    def chain(states: DataFrame) -> DataFrame:
        tails = F.collect_list("_tail").over(before_current(t.earlier(), depth))
        return states.withColumn("_before", F.flatten(F.reverse(tails)))

    tail = F.max_by(F.slice("_tail", F.lit(1), F.least(F.col(ROW), F.lit(depth)).cast("int")), F.col(ROW)).alias("_tail")
    out = [
        F.when(F.col(ROW) > k, F.col(f"_lag{i}_{k}"))
        .otherwise(F.get(F.col("_before"), (F.lit(k) - F.col(ROW)).cast("int"))[f"x{i}"])
        .alias(name)
        for i, _, k, name in pairs
    ]
    rows = F.array(*[row(back) for back in range(depth)]).alias("_tail")
    return Step(lambda d: d.select("*", rows, *lags), out, [tail], chain, ["_before"])


def create_rolling_features(
    df: DataFrame,
    options: LogOptions,
    sensors: list[str] | None = None,
    timeline: Timeline | None = None,
) -> DataFrame:
    """``{sensor}_rolling_mean_{w}`` and ``_std_{w}`` over the time window (t-w, t].

    Rows of the same instant that come later in row order are not in the window.
    Sparse machines use range frames. A range frame costs its row count for each row, so
    machines with many rows per window go through panes, whose cost per row is fixed. Machines
    that are cut go by themselves, as only their panes must be spread over tasks.
    """
    chosen = sensor_columns(df, options) if sensors is None else sensors
    t = timeline or Timeline.measure(df, options)
    if t.split and len(t.cut) < t.machines:
        cut, others, timeline_of_others = t.apart(df, t.cut)
        return _rolling_by_panes(cut, options, chosen, t).unionByName(
            create_rolling_features(others, options, chosen, timeline_of_others)
        )
    if t.sparse:
        return _rolling_by_frames(df, options, chosen, t)
    by_panes = _rolling_by_panes if t.split or t.rows <= FEW_ROWS else _rolling_by_wide_panes
    if t.crowded is None or not t.fits or options.dense_rows > TIE_SLOTS // 2:
        return by_panes(df, options, chosen, t)
    crowded, calm, timeline_of_calm = t.apart(df, t.crowded)
    return by_panes(crowded, options, chosen, t).unionByName(
        _rolling_by_frames(calm, options, chosen, timeline_of_calm)
    )


def _rolling_names(sensor: str, window: str) -> tuple[str, str]:
    return f"{sensor}_rolling_mean_{window}", f"{sensor}_rolling_std_{window}"


def _rolling_by_frames(df: DataFrame, options: LogOptions, chosen: list[str], t: Timeline) -> DataFrame:
    columns = df.columns
    if not t.keyed:
        df, t = t.with_key(df)
    ordered = Window.partitionBy(*t.keys).orderBy(KEY)
    out = []
    for c in chosen:
        for name, width in options.windows_us:
            frame = ordered.rangeBetween(-(width * TIE_SLOTS - TIE_SLOTS // 2), 0)
            mean, std = _rolling_names(c, name)
            out.append(F.avg(named(c)).over(frame).alias(mean))
            out.append(F.stddev_samp(named(c)).over(frame).alias(std))
    return df.select(*map(named, columns), *out)


def pane_shifts(df: DataFrame, options: LogOptions) -> tuple[int, list[tuple]]:
    """Panes are 2 ** shift microseconds: the shift for all machines, and smaller ones for crowded machines.

    A machine's panes are halved until none holds more rows than a window group may, or until
    panes are single microseconds, whose rows cannot be told apart in time.
    """
    shift = min(w for _, w in options.windows_us).bit_length() - 1
    rows = df.select(named(options.machine).alias("m"), instant(df, options.time).alias("us")).filter("us IS NOT NULL")
    counted = rows.groupBy("m", F.shiftright("us", shift).alias("p")).count()
    limit = max(options.group_rows, rows.count() // HOT_LIMIT)
    crowded = (
        counted.filter(F.col("count") > limit).groupBy("m").agg(F.max("count").alias("n")).collect()
    )  # at most HOT_LIMIT rows
    kind = df.schema[options.machine].dataType.simpleString()
    halved: dict = {}
    while crowded:
        narrower = {r["m"]: min(shift, halved.get(r["m"], 0) + math.ceil(math.log2(r["n"] / limit))) for r in crowded}
        narrower = {m: h for m, h in narrower.items() if h > halved.get(m, 0)}
        if not narrower:
            break  # single microseconds
        halved |= narrower
        listed = df.sparkSession.createDataFrame([(m, shift - h) for m, h in narrower.items()], f"_m {kind}, _shift int")
        again = rows.join(F.broadcast(listed), rows["m"].eqNullSafe(listed["_m"]))  # at most HOT_LIMIT rows
        again = again.groupBy("m", F.call_function("shiftright", "us", "_shift").alias("p")).count()
        crowded = again.filter(F.col("count") > limit).groupBy("m").agg(F.max("count").alias("n")).collect()
    return shift, [(m, shift - h) for m, h in halved.items()]


def _rolling_by_wide_panes(df: DataFrame, options: LogOptions, chosen: list[str], t: Timeline) -> DataFrame:
    """Panes as wide as the window: window = end of the pane it starts in + head of its own pane.

    No whole pane lies between, and parts are merged as they are among smaller panes. For machines
    that are not cut: none of their panes holds too many rows, and all steps are done where the rows
    of a machine lie, so rows move once and nothing made of them does.
    """
    m = named(options.machine)
    columns = df.columns
    rows = t.together(df).withColumn("_at", instant(df, options.time))
    place = lambda w: F.pmod(F.col("_at"), F.lit(w))
    start = lambda w: F.col("_at") - place(w)

    def heads_over(w: int) -> WindowSpec:
        return up_to_current(Window.partitionBy(m, start(w)).orderBy("_at", *[named(c) for c in options.order]))

    sensors = list(enumerate(chosen))
    heads = [M.moments(named(c), heads_over(w)).alias(f"_r{i}_{j}") for i, (_, w) in enumerate(options.windows_us) for j, c in sensors]
    rows = rows.select("*", *heads)
    carried = {options.machine, "_at", *chosen}
    for i, (_, w) in enumerate(options.windows_us):
        kept = rows.columns
        # Each reading once more in the next pane, where readings leave the window in the order in which they came.
        events = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_kind"))
        events = events.select(
            *[named(c) if c in carried else F.when(F.col("_kind") == 0, named(c)).alias(c) for c in kept],
            "_kind",
            (start(w) + F.col("_kind") * F.lit(w)).alias("_pane"),
            place(w).alias("_place"),
        )
        # Readings still inside the window: they leave it after this row.
        leaving = up_to_current(Window.partitionBy(m, "_pane").orderBy(F.col("_place").desc(), F.col("_kind").asc()))
        tails = [M.moments(F.when(F.col("_kind") == 1, named(c)), leaving).alias(f"_t{j}") for j, c in sensors]
        own = events.select("*", *tails).filter(F.col("_kind") == 0)
        wholes = {f"_r{i}_{j}": M.merge(F.col(f"_t{j}"), F.col(f"_r{i}_{j}")) for j, _ in sensors}
        rows = own.select(*[wholes[c].alias(c) if c in wholes else named(c) for c in kept])
    return rows.select(*map(named, columns), *_rolling_columns(options, chosen))


def _rolling_columns(options: LogOptions, chosen: list[str]) -> list[Column]:
    """Means and deviations of the moments ``_r{window}_{sensor}``."""
    out = []
    for j, c in enumerate(chosen):
        for i, (name, _) in enumerate(options.windows):
            mean, std = _rolling_names(c, name)
            both = F.col(f"_r{i}_{j}")
            out += [M.mean_of(both).alias(mean), M.sample_std_of(both).alias(std)]
    return out


def _rolling_by_panes(df: DataFrame, options: LogOptions, chosen: list[str], t: Timeline) -> DataFrame:
    """Window = end of the pane it starts in + whole panes + head of its own pane.

    Readings moved forward by a window land in one later pane, where running sums from the end
    give what is still in the window. A window that is no multiple of the pane starts its whole
    panes with the rest of one, cut at the same place in all panes. Whole panes come from sums at
    all powers of two. Parts are merged as (n, mean, m2), so nothing is ever subtracted. The
    window group is (machine, pane), whatever a machine holds in total.
    """
    m = named(options.machine)
    columns = df.columns
    shift, narrow = pane_shifts(df, options)

    key = F.coalesce(m.cast("string"), F.lit(NO_MACHINE))
    df = df.withColumns({"_at": instant(df, options.time), "_pm": key})
    if narrow:
        kind = df.schema[options.machine].dataType.simpleString()
        table = F.broadcast(df.sparkSession.createDataFrame(narrow, f"_hot {kind}, _shift int"))
        df = df.join(table, m.eqNullSafe(table["_hot"]), "left").drop("_hot")
        df = df.withColumn("_shift", F.coalesce(F.col("_shift"), F.lit(shift)))
    else:
        df = df.withColumn("_shift", F.lit(shift))
    pane_of = lambda at: F.call_function("shiftright", at, F.col("_shift"))

    copies = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("_at").alias("at")),
        *[
            F.struct(F.lit(i + 1).alias("kind"), (F.col("_at") + F.lit(w)).alias("at"))
            for i, (_, w) in enumerate(options.windows_us)
        ],
    )
    carried = set(chosen)
    events = df.select(*map(named, columns), "_pm", "_shift", F.explode(copies).alias("_c")).select(
        "_pm",
        *[
            named(c) if c in carried else F.when(F.col("_c.kind") == 0, named(c)).alias(c)
            for c in columns
        ],
        F.col("_c.kind").alias("_kind"),
        F.col("_c.at").alias("_at"),
        pane_of(F.col("_c.at")).alias("_pane"),
    )
    # Readings still inside the window: they leave it after this row.
    leaving = up_to_current(
        Window.partitionBy("_pm", "_pane").orderBy(F.col("_at").desc(), F.col("_kind").asc())
    )
    tails = [
        M.moments(F.when(F.col("_kind") == i + 1, named(c)), leaving).alias(f"_t{i}_{j}")
        for i in range(len(options.windows))
        for j, c in enumerate(chosen)
    ]
    own = events.select("*", *tails).filter(F.col("_kind") == 0)
    heads_over = up_to_current(
        Window.partitionBy("_pm", "_pane").orderBy("_at", *[named(c) for c in options.order])
    )
    own = own.select("*", *[M.moments(named(c), heads_over).alias(f"_h{j}") for j, c in enumerate(chosen)])
    between = _between_panes(df.withColumn("_pane", pane_of(F.col("_at"))), options, chosen)
    joined = own.join(between, (F.col("_pm") == F.col("_m")) & (F.col("_pane") == F.col("_p")), "left")

    def whole(i: int, j: int) -> Column:
        inner = F.coalesce(F.col(f"_b{i}_{j}"), M.no_moments())
        return M.merge(M.merge(F.col(f"_t{i}_{j}"), inner), F.col(f"_h{j}"))

    wholes = joined.select(
        *map(named, columns),
        *[whole(i, j).alias(f"_r{i}_{j}") for i in range(len(options.windows)) for j in range(len(chosen))],
    )
    return wholes.select(*map(named, columns), *_rolling_columns(options, chosen))


def _between_panes(df: DataFrame, options: LogOptions, chosen: list[str]) -> DataFrame:
    """(_m, _p, _b{window}_{sensor}): readings of a window before pane _p and after the pane it starts in.

    Sums of 2 ** level panes side by side exist once per level; the panes of a window are at most
    two sums per level. All groups are (machine, level, place), none is as long as a machine.
    """
    widths = [w for _, w in options.windows_us]
    width = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_shift"))
    # Where in a pane the whole panes of a window start, 0 where they start with one.
    cut = lambda w: F.pmod(F.lit(-w), width)
    place = F.pmod(F.col("_at"), width)
    sums = df.filter(F.col("_at").isNotNull()).groupBy(F.col("_pm").alias("_m"), "_shift", F.col("_pane").alias("_p")).agg(
        F.struct(*[M.moments(named(c)).alias(f"x{j}") for j, c in enumerate(chosen)]).alias("_x"),
        *[
            F.struct(
                *[M.moments(F.when((cut(w) > 0) & (place >= cut(w)), named(c))).alias(f"x{j}") for j, c in enumerate(chosen)]
            ).alias(f"_x{i}")
            for i, w in enumerate(widths)
        ],
    )
    sums = written(sums, "panes")
    shifted = lambda x, k: F.call_function("shiftright", x, k)
    most = F.call_function("shiftright", F.lit(max(widths)), F.col("_shift"))
    levels = F.sequence(F.lit(0), F.length(F.bin(most.cast("long"))) - 1)
    # Rests of panes are kept at levels below 0, one per window.
    nodes = F.concat(
        F.transform(levels, lambda k: F.struct(k.alias("level"), shifted(F.col("_p"), k).alias("place"), F.col("_x").alias("x"))),
        F.array(*[F.struct(F.lit(-1 - i).alias("level"), F.col("_p").alias("place"), F.col(f"_x{i}").alias("x")) for i in range(len(widths))]),
    )
    sensors = range(len(chosen))
    kept = sums.select("_m", F.explode(nodes).alias("_n")).groupBy("_m", F.col("_n.level").alias("level"), F.col("_n.place").alias("place")).agg(
        *[M.merge_all(F.collect_list(F.col(f"_n.x.x{j}"))).alias(f"_x{j}") for j in sensors]
    )

    def asked(i: int, w: int) -> Column:
        panes = shifted(F.lit(w), F.col("_shift"))
        first, last = F.col("_p") - panes + 1, F.col("_p") - 1

        def at(k: Column) -> Column:
            low, high = -shifted(-first, k), shifted(last + 1, k) - 1
            one = lambda p: F.struct(F.lit(i).alias("window"), k.alias("level"), p.alias("place"))
            left = F.when((low <= high) & (F.pmod(low, F.lit(2)) == 1), F.array(one(low)))
            right = F.when((low <= high) & (F.pmod(high, F.lit(2)) == 0), F.array(one(high)))
            nothing = F.filter(F.array(one(low)), lambda x: F.lit(False))
            return F.concat(F.coalesce(left, nothing), F.coalesce(right, nothing))

        rest = F.struct(F.lit(i).alias("window"), F.lit(-1 - i).alias("level"), (F.col("_p") - panes).alias("place"))
        return F.concat(F.flatten(F.transform(levels, at)), F.array(rest))

    asks = sums.select("_m", "_p", F.explode(F.concat(*[asked(i, w) for i, w in enumerate(widths)])).alias("_a"))
    asks = asks.select("_m", "_p", F.col("_a.window").alias("window"), F.col("_a.level").alias("level"), F.col("_a.place").alias("place"))
    # Spark judges both sides by the size of the written table, not by the many rows made of it.
    held = sums.agg(F.count("*").alias("panes"), F.min("_shift").alias("shift")).first()
    asked_most = held["panes"] * len(widths) * (2 * (max(widths) >> (held["shift"] or 0)).bit_length() + 1)
    many = asked_most > BROADCAST_ROWS
    met = asks.join(kept.hint("merge") if many else kept, ["_m", "level", "place"])
    between = met.groupBy("_m", "_p").agg(
        *[
            M.merge_all(F.collect_list(F.when(F.col("window") == i, F.col(f"_x{j}")))).alias(f"_b{i}_{j}")
            for i in range(len(widths))
            for j in sensors
        ]
    )
    return between.hint("merge") if many else between


def _ema_name(sensor: str, alpha: float) -> str:
    return f"{sensor}_ema_{alpha}"


def create_ema_features(
    df: DataFrame,
    options: LogOptions,
    sensors: list[str] | None = None,
    timeline: Timeline | None = None,
    filled: bool = False,
) -> DataFrame:
    """``{sensor}_ema_{a}``: y0 = x0, y = a*x + (1-a)*y_prev, per machine.

    Over a gap of g rows the old average weighs (1-a)^g against a for the new reading, and
    rows without a reading keep the average. ``filled`` says that gaps were filled before;
    otherwise one aggregate finds the sensors that have some.
    """
    chosen = sensor_columns(df, options) if sensors is None else sensors
    t = timeline or Timeline.measure(df, options)
    steps = ema_steps(df, options, chosen, t, filled)
    made = t.run(df, steps, [*map(named, df.columns)])
    return made.select(*map(named, df.columns), *[named(_ema_name(c, a)) for c in chosen for a in options.alphas])


def ema_steps(df: DataFrame, options: LogOptions, chosen: list[str], t: Timeline, filled: bool) -> list[Step]:
    """Averages as maps y -> factor * y + offset, one per reading, which compose.

    In a block of rows the composed map is a scaled running sum. Blocks are so long that a map of
    a few of them forgets all before it, down to the last bit of a double; so few are composed.
    Segments hand on their map, and maps of all segments before are composed by doubling.
    """
    gappy = [] if filled else _gappy_sensors(df, options, chosen)
    return [
        make(options, numbered, t)
        for make, numbered in (
            (_whole_step, [(i, c) for i, c in enumerate(chosen) if c not in gappy]),
            (_gappy_step, [(i, c) for i, c in enumerate(chosen) if c in gappy]),
        )
        if numbered
    ]


def _gappy_sensors(df: DataFrame, options: LogOptions, chosen: list[str]) -> list[str]:
    """Sensors with both readings and gaps on some machine."""
    known = df.groupBy(named(options.machine)).agg(
        F.count("*").alias("_n"), *[F.count(named(c)).alias(f"_k{i}") for i, c in enumerate(chosen)]
    )
    some = lambda i: (F.col(f"_k{i}") > 0) & (F.col(f"_k{i}") < F.col("_n"))
    found = known.agg(*[F.bool_or(some(i)).alias(f"g{i}") for i in range(len(chosen))]).first()
    return [c for i, c in enumerate(chosen) if found[f"g{i}"]]


def _decay(alpha: float) -> float:
    return -math.log(1.0 - alpha)


def _block_groups(alphas: list[float]) -> list[tuple[int, list[float]]]:
    """Rows of a block, and the averages it serves."""
    groups: list[list[float]] = []
    for a in sorted(alphas, reverse=True):
        if groups and _decay(groups[-1][0]) <= SHARED * _decay(a):
            groups[-1].append(a)
        else:
            groups.append([a])
    return [(max(1, int(RANGE / _decay(g[0]))), g) for g in groups]


def _composed(states: DataFrame, t: Timeline, maps: list[tuple[str, str]]) -> DataFrame:
    """Map (factor, offset) of each segment replaced by that of it and all segments of its machine before it."""
    for k in range(max(1, t.segments - 1).bit_length()):
        states = states.withColumns({f"_b{c}": F.lag(c, 1 << k).over(t.earlier()) for pair in maps for c in pair})
        both = {}
        for factor, offset in maps:
            f, o, seen = F.col(factor), F.col(offset), F.col(f"_b{factor}").isNotNull()
            both[offset] = F.when(seen & (f != 0), f * F.col(f"_b{offset}") + o).otherwise(o)
            both[factor] = F.when(seen, f * F.col(f"_b{factor}")).otherwise(f)
        states = states.withColumns(both)
    return states.drop(*[f"_b{c}" for pair in maps for c in pair])


def _whole_step(options: LogOptions, numbered: list[tuple[int, str]], t: Timeline) -> Step:
    """Averages of sensors without gaps (a sensor may be empty for a whole machine).

    Blocks have a fixed number of rows. Sums of blocks before are added one, two, four, ...
    blocks at a time, as far as a reading can still be seen.
    """
    smooth = [(k, a) for k, a in enumerate(options.alphas) if a < 1]
    number = {a: k for k, a in smooth}
    groups = _block_groups([a for _, a in smooth])
    rn = F.col(ROW)
    pow_ = lambda a, n: F.pow(F.lit(1.0 - a), n)

    def inside(df: DataFrame) -> DataFrame:
        first = [F.first(named(c)).over(up_to_current(t.forward())).cast("double").alias(f"_x{i}") for i, c in numbered]
        df = df.select("*", *first)
        for block, alphas in groups:
            cells = [(i, c, a, f"_l{i}_{number[a]}") for i, c in numbered for a in alphas]
            df = df.withColumns({"_blk": F.floor((rn - 1) / block), "_j": F.pmod(rn - 1, F.lit(block))})
            j, middle = F.col("_j"), block // 2
            blocks = max(1, math.ceil(t.max_rows / block))
            # Where every machine fits one block, the sort of the other steps serves.
            one = t.forward() if blocks == 1 else Window.partitionBy(*t.keys, F.col("_blk")).orderBy(*t.ascending())
            rows = up_to_current(one)
            df = df.select(
                "*",
                *[
                    (pow_(a, j - middle) * F.sum(F.lit(a) * pow_(a, middle - j) * named(c)).over(rows)).alias(name)
                    for i, c, a, name in cells
                ],
            )
            enough = math.ceil(VANISHED / (block * _decay(alphas[-1]))) + 1
            for step in range((min(blocks, enough) - 1).bit_length()):
                span = 1 << step
                # Ends of the blocks up to ``span`` before this one; the last is the nearest.
                ended = Window.partitionBy(*t.keys).orderBy("_blk").rangeBetween(Window.unboundedPreceding, -span)
                end = lambda name: F.last(F.when(j == block - 1, F.col(name)), ignorenulls=True).over(ended)  # noqa: B023, E731
                df = df.select("*", *[end(name).alias(f"_end{name}") for *_, name in cells])
                reach = j + (1 + (span - 1) * block)
                df = df.withColumns({
                    name: F.when(F.col(f"_end{name}").isNull(), F.col(name)).otherwise(F.col(name) + pow_(a, reach) * F.col(f"_end{name}"))
                    for _, _, a, name in cells
                }).drop(*[f"_end{name}" for *_, name in cells])
            df = df.drop("_blk", "_j")
        return df

    cells = [(i, k, a) for i, _ in numbered for k, a in smooth]

    def chain(states: DataFrame) -> DataFrame:
        before = before_current(t.earlier())
        later = F.count("*").over(before) > 0
        maps = {}
        for i, k, a in cells:
            whole = pow_(a, F.col("_last"))
            maps[f"_f{i}_{k}"] = F.when(later, whole).otherwise(F.lit(0.0))
            maps[f"_z{i}_{k}"] = F.when(later, F.col(f"_z{i}_{k}")).otherwise(F.col(f"_z{i}_{k}") + whole * F.col(f"_q{i}"))
        states = _composed(states.withColumns(maps), t, [(f"_f{i}_{k}", f"_z{i}_{k}") for i, k, _ in cells])
        return states.withColumns({f"_c{i}_{k}": F.lag(f"_z{i}_{k}").over(t.earlier()) for i, k, _ in cells})

    summary, passed = [], []
    if t.split:
        summary = [F.max(rn).alias("_last")]
        summary += [F.max_by(F.col(f"_l{i}_{k}"), rn).alias(f"_z{i}_{k}") for i, k, _ in cells]
        summary += [F.first(f"_x{i}").alias(f"_q{i}") for i, _ in numbered]
        passed = [f"_c{i}_{k}" for i, k, _ in cells]
    out = []
    for i, c in numbered:
        for k, a in enumerate(options.alphas):
            start = F.coalesce(F.col(f"_c{i}_{k}"), F.col(f"_x{i}")) if t.split and a < 1 else F.col(f"_x{i}")
            y = named(c).cast("double") if a >= 1 else F.col(f"_l{i}_{k}") + pow_(a, rn) * start
            out.append(y.alias(_ema_name(c, a)))
    return Step(inside, out, summary, chain, passed)


def _gappy_step(options: LogOptions, numbered: list[tuple[int, str]], t: Timeline) -> Step:
    """Averages over gaps: blocks are cut by decay instead of by rows.

    ``_y``: average from the readings of the segment but the first, which is a start like the
    average handed on; ``_d``: decay of that start.
    """
    smooth = [(k, a) for k, a in enumerate(options.alphas) if a < 1]
    rn = F.col(ROW)
    up_to, before = up_to_current(t.forward()), before_current(t.forward())
    seen = lambda i: F.col(f"_at{i}")
    all_cells = [(i, c, k, a) for i, c in numbered for k, a in smooth]

    def inside(df: DataFrame) -> DataFrame:
        df = df.select(
            "*",
            *[F.last(F.when(named(c).isNotNull(), rn), True).over(before).alias(f"_was{i}") for i, c in numbered],
            *[F.last(F.when(named(c).isNotNull(), rn), True).over(up_to).alias(f"_at{i}") for i, c in numbered],
            *[F.first(F.when(named(c).isNotNull(), rn), True).over(up_to).alias(f"_from{i}") for i, c in numbered],
            *[F.first(named(c), True).over(up_to).cast("double").alias(f"_x{i}") for i, c in numbered],
            *[F.last(named(c), True).over(up_to).cast("double").alias(f"_v{i}") for i, c in numbered],
        )
        def make(name: str, of) -> None:
            """One column per average, made of those before; all averages at once keep the plan short."""
            nonlocal df
            df = df.withColumns({f"_{name}{i}_{k}": of(i, c, a, lambda other, at=f"{i}_{k}": F.col(f"_{other}{at}")) for i, c, k, a in all_cells})

        def block(col) -> WindowSpec:
            return up_to_current(Window.partitionBy(*t.keys, col("blk")).orderBy(*t.ascending()))

        def order(col) -> WindowSpec:
            return Window.partitionBy(*t.keys).orderBy(col("blk"), *t.ascending())

        counts = lambda i, c: named(c).isNotNull() & F.col(f"_was{i}").isNotNull()
        gap = lambda i, a: (rn - F.col(f"_was{i}")) * F.lit(_decay(a))
        weight = lambda i, a: F.exp(-gap(i, a)) + F.lit(a)
        make("step", lambda i, c, a, col: F.when(counts(i, c), gap(i, a) + F.log(weight(i, a))).otherwise(F.lit(0.0)))
        make("new", lambda i, c, a, col: F.when(counts(i, c), F.lit(a) * named(c) / weight(i, a)).otherwise(F.lit(0.0)))
        make("d", lambda i, c, a, col: F.sum(col("step")).over(up_to))
        make("blk", lambda i, c, a, col: F.floor(col("d") / RANGE))
        # Decay since the block before and since the block's first row; from the latter the scaled sum.
        make("in", lambda i, c, a, col: F.sum(col("step")).over(block(col)))
        make("since", lambda i, c, a, col: col("in") - F.first(col("step")).over(block(col)))
        make("sum", lambda i, c, a, col: F.sum(F.exp(col("since") - RANGE / 2) * col("new")).over(block(col)))
        make("own", lambda i, c, a, col: F.exp(RANGE / 2 - col("since")) * col("sum"))
        make("ends", lambda i, c, a, col: F.coalesce(F.lead(col("blk")).over(order(col)) != col("blk"), F.lit(False)))
        make("y", lambda i, c, a, col: col("own"))
        for _ in range(math.ceil(VANISHED / RANGE)):
            make("end", lambda i, c, a, col: F.last(F.when(col("ends"), col("y")), True).over(before_current(order(col))))
            make("y", lambda i, c, a, col: col("own") + F.exp(-col("in")) * F.coalesce(col("end"), F.lit(0.0)))
        gone = ("step", "new", "blk", "in", "since", "sum", "own", "ends", "end")
        return df.drop(*[f"_{name}{i}_{k}" for name in gone for i, _, k, _ in all_cells])

    cells = [(i, k, a) for i, _ in numbered for k, a in smooth]

    def chain(states: DataFrame) -> DataFrame:
        earlier = before_current(t.earlier())
        states = states.withColumn("_gone", F.coalesce(F.sum("_rows_held").over(earlier), F.lit(0)))
        for i, _ in numbered:
            last = F.last(F.col("_gone") + F.col(f"_at{i}"), True).over(earlier)
            states = states.withColumns({f"_prev{i}": last, f"_seen{i}": F.last(f"_v{i}", True).over(earlier)})
        def make(of) -> None:
            nonlocal states
            states = states.withColumns({name: column for i, k, a in cells for name, column in of(i, k, a).items()})

        old = lambda i, a: F.exp(-F.lit(_decay(a)) * (F.col("_gone") + F.col(f"_from{i}") - F.col(f"_prev{i}")))
        alone = lambda i: F.col(f"_prev{i}").isNull()
        none = lambda i: F.col(f"_at{i}").isNull()
        make(lambda i, k, a: {
            f"_first{i}_{k}": F.when(alone(i), F.col(f"_x{i}")).otherwise(F.lit(a) * F.col(f"_x{i}") / (old(i, a) + a)),
            f"_keep{i}_{k}": F.when(alone(i), F.lit(0.0)).otherwise(old(i, a) / (old(i, a) + a)),
            f"_ends{i}_{k}": F.exp(-F.col(f"_d{i}_{k}")),
        })
        make(lambda i, k, a: {
            f"_g{i}_{k}": F.when(none(i), F.lit(1.0)).otherwise(F.col(f"_ends{i}_{k}") * F.col(f"_keep{i}_{k}")),
            f"_o{i}_{k}": F.when(none(i), F.lit(0.0)).otherwise(F.col(f"_ends{i}_{k}") * F.col(f"_first{i}_{k}") + F.col(f"_y{i}_{k}")),
        })
        states = _composed(states, t, [(f"_g{i}_{k}", f"_o{i}_{k}") for i, k, _ in cells])
        make(lambda i, k, a: {f"_p{i}_{k}": F.when(~alone(i), F.lag(f"_o{i}_{k}").over(t.earlier()))})
        make(lambda i, k, a: {f"_s{i}_{k}": F.col(f"_keep{i}_{k}") * F.coalesce(f"_p{i}_{k}", F.lit(0.0)) + F.col(f"_first{i}_{k}")})
        return states.withColumnsRenamed({f"_seen{i}": f"_w{i}" for i, _ in numbered})

    summary, passed = [], []
    if t.split:
        summary = [F.max(rn).alias("_rows_held")]
        for i, _ in numbered:
            summary += [F.max(seen(i)).alias(f"_at{i}"), F.min(f"_from{i}").alias(f"_from{i}")]
            summary += [F.max_by(f"_{n}{i}", rn).alias(f"_{n}{i}") for n in "xv"]
            passed.append(f"_w{i}")
        for i, k, _ in cells:
            summary += [F.max_by(f"_{n}{i}_{k}", rn).alias(f"_{n}{i}_{k}") for n in "dy"]
            passed += [f"_p{i}_{k}", f"_s{i}_{k}"]
    out = []
    for i, c in numbered:
        for k, a in enumerate(options.alphas):
            if a >= 1:
                y = F.coalesce(F.col(f"_v{i}"), F.col(f"_w{i}")) if t.split else F.col(f"_v{i}")
            else:
                start = F.col(f"_s{i}_{k}") if t.split else F.col(f"_x{i}")
                y = F.when(seen(i).isNotNull(), F.col(f"_y{i}_{k}") + F.exp(-F.col(f"_d{i}_{k}")) * start)
                y = F.coalesce(y, F.col(f"_p{i}_{k}")) if t.split else y
            out.append(y.alias(_ema_name(c, a)))
    return Step(inside, out, summary, chain, passed)


def feature_pipeline(
    df: DataFrame,
    options: LogOptions,
    sensors: list[str] | None = None,
    timeline: Timeline | None = None,
    filled: bool = False,
) -> DataFrame:
    """Lags, rolling windows, exponential averages and the target, in this order.

    ``filled`` says that the sensors have no gaps, as after cleaning.
    """
    chosen = sensor_columns(df, options) if sensors is None else sensors
    if not chosen:
        raise ValueError("no sensor columns found for feature engineering")
    t = timeline or Timeline.measure(df, options)
    df = normalise_failure(df, options)
    columns = [c for c in df.columns if c != options.target]
    if t.sparse:
        # One exchange by machine and one sort by the row key serve all steps.
        df, t = t.with_key(df)
    steps = [lag_step(options, chosen, t), *ema_steps(df, options, chosen, t, filled), target_step(df, options, t)]
    # Windows on panes have an exchange of their own, the steps share one.
    rolled = create_rolling_features(df, options, chosen, t)
    windows = [name for c in chosen for w, _ in options.windows for name in _rolling_names(c, w)]
    made = t.run(rolled, steps, [*map(named, columns + windows)])
    lags = [f"{c}_lag_{k}" for c in chosen for k in options.lags]
    averages = [_ema_name(c, a) for c in chosen for a in options.alphas]
    return made.select(*map(named, columns + lags + windows + averages), named(options.target))
