"""CSV records whose quoted cells span lines, read in splits.

A line is read without knowing whether it starts inside a quoted cell, so each line is a map of two
states, outside and inside, to the state at its end. Maps compose: every block of a file is summed
up as one map and as the records that start in it in either case, the states at block borders are
chained over that table, one line per block, and lines then know where they start. Lines that
are a record of their own pass; only lines of longer records are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gearwatch.session import written

# A cell in quotes, from the start of a line or a comma to a comma or the end.
_CELL = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|\r?$)'
# The rest of a cell that began on an earlier line.
_REST = r'^[^"]*+(?:""[^"]*+)*+"(?=,|\r?$)'


def _opens(line: Column) -> Column:
    """Whether a line that starts outside a cell ends inside one: a quoted cell begins and never ends."""
    return F.regexp_replace(line, _CELL, "$1").rlike('(^|,)"')


def _ends() -> tuple[Column, Column]:
    """State at the end of a line by the state at its start: outside, inside."""
    line = F.col("value")
    closed = line.rlike(_REST)
    after = F.regexp_replace(line, _REST, "")
    return _opens(line).cast("int"), F.when(closed, _opens(after).cast("int")).otherwise(F.lit(1))


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether some line, read from outside a cell, ends inside one."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return not lines.where(F.instr("value", '"') > 0).where(_opens(F.col("value"))).isEmpty()


def csv_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(``_record``, *names): the records after each file's header, numbered in file order, cells as text.

    Quotes open a cell only at its start, so a quote elsewhere is a character like any other. Blank
    records are left out. A file that ends inside a cell is refused.
    """
    # Ids and blocks depend on how a scan is cut, so they are written once.
    lines = written(
        spark.read.option("lineSep", "\n").text(path).select(
            "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
        ),
        "lines",
    )
    inner = Window.partitionBy("_file", "_block").orderBy("_id")
    outside, inside = _ends()
    maps = lines.select("*", outside.alias("_o"), inside.alias("_i"))
    # A line keeps the state, turns it round, or sets it; turns are counted, the last set line decides.
    turned = F.sum((F.col("_o") > F.col("_i")).cast("int")).over(inner)
    maps = maps.withColumn("_turns", turned)
    fixed = F.when(F.col("_o") == F.col("_i"), F.pmod(F.col("_o") + F.col("_turns"), F.lit(2)))
    maps = maps.withColumn("_set", F.last(fixed, ignorenulls=True).over(inner))

    def state(start: Column) -> Column:
        """State after a line if its block starts in ``start``."""
        return F.pmod(F.coalesce(F.col("_set"), start) + F.col("_turns"), F.lit(2)).cast("int")

    maps = maps.withColumns({"_s0": state(F.lit(0)), "_s1": state(F.lit(1))})
    begins = lambda s, start: F.coalesce(F.lag(s).over(inner), F.lit(start))
    maps = maps.withColumns({"_b0": begins("_s0", 0), "_b1": begins("_s1", 1)})
    blocks = maps.groupBy("_file", "_block").agg(
        F.max_by("_s0", "_id").alias("_e0"), F.max_by("_s1", "_id").alias("_e1"),
        F.count_if(F.col("_b0") == 0).alias("_n0"), F.count_if(F.col("_b1") == 0).alias("_n1"),
    )
    blocks = written(_chained(blocks), "blocks")
    if not blocks.where("_last AND _after = 1").isEmpty():
        raise ValueError(f"a file ends inside a quoted cell: {path}")
    placed = maps.join(blocks.select("_file", "_block", "_start", "_before"), ["_file", "_block"])
    begin = F.when(F.col("_start") == 0, F.col("_b0")).otherwise(F.col("_b1"))
    end = F.when(F.col("_start") == 0, F.col("_s0")).otherwise(F.col("_s1"))
    placed = placed.select("_file", "_id", "_block", "_before", "value", begin.alias("_begin"), end.alias("_end"))
    record = F.col("_before") + F.sum((F.col("_begin") == 0).cast("long")).over(inner) - 1
    placed = placed.select("_file", "_id", "value", record.alias("_record"), ((F.col("_begin") == 0) & (F.col("_end") == 0)).alias("_own"))
    single = placed.where("_own").select("_file", "_record", "value")
    long = placed.where("NOT _own").groupBy("_file", "_record").agg(F.array_sort(F.collect_list(F.struct("_id", "value"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    records = single.unionByName(long.select("_file", "_record", joined.alias("value")))
    heads = blocks.where("_first").select("_file", F.col("_before").alias("_head"))
    records = records.join(heads, "_file").where(F.col("_record") > F.col("_head"))
    text = F.regexp_replace("value", r"\r$", "")
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    cells = F.from_csv(text, fields, {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    parsed = records.where(F.trim(text) != "").select("_record", cells.alias("_cells"))
    return parsed.select("_record", *[F.col(f"_cells.c{i}").alias(n) for i, n in enumerate(names)])


def _chained(blocks: DataFrame) -> DataFrame:
    """Blocks with the state they start and end in, and the records before them; one line per block."""
    own = Window.partitionBy("_file").orderBy("_block")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = blocks.withColumn("_turns", F.sum((F.col("_e0") > F.col("_e1")).cast("int")).over(upto))
    fixed = F.when(F.col("_e0") == F.col("_e1"), F.pmod(F.col("_e0") + F.col("_turns"), F.lit(2)))
    blocks = blocks.withColumn("_set", F.last(fixed, ignorenulls=True).over(upto))
    blocks = blocks.withColumn("_after", F.pmod(F.coalesce("_set", F.lit(0)) + F.col("_turns"), F.lit(2)).cast("int"))
    blocks = blocks.withColumn("_start", F.coalesce(F.lag("_after").over(own), F.lit(0)))
    blocks = blocks.withColumn("_n", F.when(F.col("_start") == 0, F.col("_n0")).otherwise(F.col("_n1")))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        "_file", "_block", "_start", "_after", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.lag("_block").over(own).isNull().alias("_first"), F.lead("_block").over(own).isNull().alias("_last"),
    )
