"""Merkle manifest of a table: a digest per row, per group and for the whole, with proofs.

Rows of a group are ranked, and the rank is written in digits. A block is the ``FAN ** DIGITS`` rows
that share all but the last digits; inside it the digits are grouped away one by one, each step
nesting the structs of a run into one struct with their common digest. A block is one row of at most
4,096 leaves, whatever the group holds. Block digests are the leaves of the next rollup, and so on
up to the group's digest; groups are rolled up the same way.

On the way down the nested structs of a block are opened step by step with ``transform`` and
``explode``: every child leaves with the digests to its left and right, so no join gives a leaf
its proof. Only whole blocks meet their own proof from the rollup above, one row per block.

Texts never move: digests are made where rows are read. Expressions only, no Python workers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearwatch.llm.common import stored

#: Nodes of a run, and digits of a block.
FAN, DIGITS = 8, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A proof: the digests left and right of each node from the leaf to the root.
PATH = "array<struct<left:string,right:string>>"


def entry(column: Column) -> Column:
    """A value as a leaf takes it: ``-`` if null, else its UTF-8 length, a colon and itself."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(columns: list[Column]) -> Column:
    return digest(*map(entry, columns))


def fold(path: Column, start: Column) -> Column:
    """The digest a node leads to along its path."""
    return F.aggregate(path, start, lambda own, step: digest(step["left"], own, step["right"]))


def siblings(path: Column) -> Column:
    """All digests of a path, joined from the leaf to the root, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``rank`` in their group ``grp`` and the group's size ``n``.

    Rows are sorted in ranges over all groups, so one large group is spread like any other; a range
    adds the rows of its group in the ranges before it. Only those counts are put in a window.
    """
    keys = [F.col("grp").asc(), *[F.col(c).asc_nulls_first() for c in order]]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    laid, _ = stored(laid.select("*", F.shiftright(place, 33).alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), label)
    parts = laid.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first")
    parts = parts.select("grp", "part", before.alias("shift"), F.sum("held").over(Window.partitionBy("grp")).alias("n"))
    return laid.join(parts, ["grp", "part"]).withColumn("rank", F.col("at") + F.col("shift"))


def _steps(n: Column, d: int) -> Column:
    """Nodes of a group of ``n`` before digit d is grouped away; one is the end."""
    return F.ceil(n / F.lit(FAN**d))


def rollup(nodes: DataFrame, depth: int = DIGITS) -> DataFrame:
    """(grp, n, block, node, below): blocks of ``nodes`` (grp, n, rank, node, below) as nested structs.

    ``n`` is the number of nodes of the group. Steps beyond the one digest a group ends with hand
    their only child on as it is.
    """
    size = F.lit(FAN**depth)
    digits = [F.pmod(F.call_function("div", F.col("rank"), F.lit(FAN**d)), F.lit(FAN)).cast("int").alias(f"d{d}") for d in range(depth)]
    rows = nodes.select("grp", "n", F.call_function("div", F.col("rank"), size).alias("block"), *digits, "node", "below")
    # Hash ranges of blocks hold for all steps: they group without another exchange.
    rows = rows.repartition("grp", "block")
    for d in range(depth):
        keys = ["grp", "n", "block", *[f"d{i}" for i in range(d + 1, depth)]]
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(f"d{d}", "node", "below"))).alias("below"))
        joined = F.array_join(F.transform("below", lambda kid: kid["node"]), "")
        rows = rows.withColumn("node", F.when(_steps(F.col("n"), d) > 1, F.sha2(joined, 256)).otherwise(F.col("below")[0]["node"]))
    return rows.select("grp", "n", "block", "node", "below")


def opened(blocks: DataFrame, depth: int = DIGITS) -> DataFrame:
    """(grp, rank, node, below, path, *others) per node of ``blocks``, which bring their own ``path``."""
    others = [c for c in blocks.columns if c not in ("grp", "n", "block", "node", "below", "path")]
    rows = blocks.select("grp", "n", F.col("block").alias("rank"), "below", "path", *others)
    for d in reversed(range(depth)):
        named = rows.withColumn("nodes", F.transform("below", lambda kid: kid["node"]))
        beside = lambda i, start, n: F.array_join(F.slice("nodes", start, n), "")
        kid = F.transform(
            "below",
            lambda own, i: F.struct(
                own["node"].alias("node"), own["below"].alias("below"), own[f"d{d}"].alias("digit"),
                beside(i, F.lit(1), i).alias("left"), beside(i, i + 2, F.lit(FAN)).alias("right"),
            ),
        )
        rows = named.select("grp", "n", "rank", "path", *others, F.explode(kid).alias("kid"))
        step = F.array(F.struct(F.col("kid.left").alias("left"), F.col("kid.right").alias("right")))
        path = F.when(_steps(F.col("n"), d) > 1, F.concat(step, F.col("path"))).otherwise(F.col("path"))
        rank = F.col("rank") * FAN + F.col("kid.digit")
        rows = rows.select("grp", "n", rank.alias("rank"), "kid.node", "kid.below", path.alias("path"), *others)
    return rows.drop("n")


def _rolled(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Blocks of every rollup until each group is one block; the last holds the groups' digests."""
    levels = []
    while True:
        blocks, _ = stored(rollup(nodes), label)
        levels.append(blocks)
        most = blocks.agg(F.max("n")).first()[0]
        if most is None or most <= FAN**DIGITS:
            return levels
        rest = F.ceil(F.col("n") / F.lit(FAN**DIGITS)).cast("long")
        nodes = blocks.select("grp", rest.alias("n"), F.col("block").alias("rank"), "node", F.lit(0).alias("below"))


def _proven(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Leaves with their paths; ``above`` has the path of each group's digest and whatever goes on."""
    top = above.join(levels[-1], "grp")
    leaves = opened(top)
    for blocks in reversed(levels[:-1]):
        paths = leaves.drop("node", "below").withColumnRenamed("rank", "block")
        leaves = opened(blocks.join(paths, ["grp", "block"]))
    return leaves


def manifest(
    rows: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """(id, leaf, subroot, root, path, *extra) per row.

    A leaf is the digest of ``fields``, each ``-`` if null. In its group leaves ascend by id, null
    first, then by digest, so repeated rows have equal leaves side by side. Groups are ordered null
    first, then bytewise. A lone leaf is its group's digest, a lone group's digest the root. ``extra``
    are columns made from the row and carried along. An empty table gives no rows; other columns of
    the table are ignored.
    """
    leaf = leaf_of([F.col(f"`{c}`") for c in fields])
    # Null is before every text, the empty one too.
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    extra = extra or {}
    made = rows.select(group.alias("grp"), F.col(f"`{id_col}`").alias("id"), leaf.alias("leaf"), *[c.alias(name) for name, c in extra.items()])
    ranked = _ranked(made, ["id", "leaf"], "leaves")
    below = F.struct("id", *extra)
    groups = _rolled(ranked.select("grp", "n", "rank", F.col("leaf").alias("node"), below.alias("below")), "blocks")
    subroots = groups[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
    named = _ranked(subroots, ["name"], "groups")
    whole = _rolled(named.select("grp", "n", "rank", "node", F.struct("name").alias("below")), "whole")
    roots = whole[-1].select("grp", F.col("node").alias("root"), F.array().cast(PATH).alias("path"))
    found = _proven(whole, roots).select(F.col("below.name").alias("grp"), F.col("node").alias("subroot"), "root", "path")
    proven = _proven(groups, found)
    return proven.select(F.col("below.id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root", "path", *[f"below.{c}" for c in extra])


def lower_az(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def tampered_leaf(share: int = 3) -> Column:
    """Digest of a document whose A-Z were lower-cased, where ``share`` divides the crc32 of its id; else null."""
    own = F.crc32(F.col("doc_id").cast("string").cast("binary")) % share
    changed = [lower_az(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    return F.when(own == 0, leaf_of(changed))


#: Steps of the SQL: groups of up to 8 ** 12 documents, and as many groups.
SQL_STEPS = 12


def _sql() -> str:
    """The same in DuckDB: one table per step, neighbours from the lists of runs."""
    entries = lambda text: " || ".join(
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)
    )
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    bit = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR z IN range(8)]), lambda a, z: {bit})"
    crc = (
        "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(z) AS BIGINT) FOR z IN string_split(CAST(doc_id AS VARCHAR), '')]),"
        f" lambda c, b: {byte}), 4294967295)"
    )
    parts = [
        f"""doc AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, sha256({entries("text")}) AS leaf,
    CASE WHEN ({crc}) % 3 = 0 THEN sha256({entries(lower)}) END AS changed FROM documents)""",
        """s0 AS MATERIALIZED (
  SELECT doc_id, grp, leaf, changed, leaf AS own, coalesce(changed, leaf) AS cur, '' AS proof,
    row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY grp) AS n FROM doc)""",
    ]

    def climb(before: str, after: str) -> str:
        """Every row one step up: ``own`` is its node, ``cur`` what its changed leaf leads to."""
        return f"""{after} AS MATERIALIZED (
  WITH node AS (SELECT DISTINCT grp, pos, own FROM {before}),
  run AS (SELECT grp, pos // 8 AS up, list(own ORDER BY pos) AS kids FROM node GROUP BY ALL)
  SELECT s.doc_id, s.leaf, s.changed, s.grp, s.pos // 8 AS pos, (s.n + 7) // 8 AS n,
    CASE WHEN s.n = 1 THEN s.own ELSE sha256(array_to_string(run.kids, '')) END AS own,
    CASE WHEN s.n = 1 THEN s.cur ELSE sha256(array_to_string(run.kids[:s.pos % 8], '') || s.cur || array_to_string(run.kids[s.pos % 8 + 2:], '')) END AS cur,
    CASE WHEN s.n = 1 THEN s.proof ELSE s.proof || array_to_string(run.kids[:s.pos % 8], '') || array_to_string(run.kids[s.pos % 8 + 2:], '') END AS proof
    {", s.subroot" if before.startswith("g") else ""}
  FROM {before} s JOIN run ON s.grp = run.grp AND s.pos // 8 = run.up)"""

    for d in range(SQL_STEPS):
        parts.append(climb(f"s{d}", f"s{d + 1}"))
    parts.append(
        f"""g0 AS MATERIALIZED (
  SELECT doc_id, leaf, changed, '' AS grp, dense_rank() OVER (ORDER BY grp) - 1 AS pos,
    (SELECT count(DISTINCT grp) FROM s{SQL_STEPS}) AS n, own, cur, proof, own AS subroot FROM s{SQL_STEPS})"""
    )
    for d in range(SQL_STEPS):
        parts.append(climb(f"g{d}", f"g{d + 1}"))
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, own AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = own AS verified FROM g{SQL_STEPS}"""


SQL = _sql()
