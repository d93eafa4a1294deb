"""Quality rules and robust multivariate outliers of text statistics, per language and source.

Base rules look at one statistic. What passes them is transformed to a vector of four numbers; per
language and source the minimum-covariance-determinant estimate of centre and covariance is found: concentration
steps from two starts (medians, and the plain mean and covariance), of which the one with the smaller
determinant is kept. Vectors at too great a Mahalanobis distance are rejected. A group too small for
an estimate is judged by that of all rows of its language, or else of all rows.

Everything is DataFrame expressions. Vectors are rounded to a grid, so sums are whole numbers and
do not depend on the order of addition, and medians need only as much memory as the grid has
points. A concentration step is one aggregate: sums per bin of distance, from which the half that
lies closest (whole bins, at least ``SUPPORT`` of the rows) is added up.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import SPACES, stored, words

#: Share of rows a concentration step keeps, number of steps, fewest rows of an estimate of its own.
SUPPORT, STEPS, LEAST_ROWS = 0.75, 4, 50
#: Chance that a row of a normal population is rejected.
REJECTED = 1e-7
GRID = 1024
#: Smallest standard deviation of each vector component: where most texts agree exactly, estimates vanish.
FLOORS = (0.05, 0.2, 0.6, 0.4)
DIMS = range(1, 5)
PAIRS = [(i, j) for i in DIMS for j in DIMS if j <= i]

#: Vector components, shrunk so that a few words say little: mean word length, symbols per
#: character, repeated lines per word, share of repeated words. Same text in Spark and DuckDB.
COMPONENTS = (
    "ln((word_chars + 250e0) / (n_words + 50e0))",
    "ln(1e0 + 100e0 * n_symbols / (word_chars + 200e0))",
    "ln(1e0 + 100e0 * n_dup_lines / (n_words + 50e0))",
    "ln(1e0 + 10e0 * n_repeat_words / (n_words + 50e0))",
)
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def chi_square_4(tail: float) -> float:
    """Quantile of the chi-square distribution of 4 degrees, by bisection of its closed form."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if math.exp(-mid / 2) * (1 + mid / 2) > tail else (low, mid)
    return high


def consistency(support: float) -> float:
    """Factor that makes the covariance of the closest share of a normal population whole."""
    q = chi_square_4(1 - support) / 2
    return support / (1 - math.exp(-q) * (1 + q + q * q / 2))


CUTOFF = round(chi_square_4(REJECTED), 6)
SCALE = round(consistency(SUPPORT), 9)


def text_statistics(docs: DataFrame, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns with word count and the four base statistics of the whole text.

    Windows of five words are told apart by 64-bit hashes within one text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    start = docs.select(
        *keep,
        words(F.col(text_col)).alias("_w"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    counted = start.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(_w) < 6 THEN array() ELSE transform(sequence(0, size(_w) - 5), i -> "
            "xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2), get(_w, i + 3), get(_w, i + 4))) END"
        ).alias("_h"),
    )
    # Most texts repeat nothing; only the others sort their windows.
    sorted_windows = counted.withColumn(
        "_s",
        F.expr(
            "CASE WHEN size(array_distinct(_h)) = size(_h) THEN array() "
            "ELSE array_sort(transform(_h, (h, i) -> struct(h AS h, i AS i))) END"
        ),
    )
    repeated = sorted_windows.withColumn(
        "_p",
        F.expr(
            "array_sort(transform(filter(_s, (x, k) -> x.h = get(_s, k - 1).h OR x.h = get(_s, k + 1).h), x -> x.i))"
        ),
    )
    covered = "aggregate(transform(_p, (p, k) -> least(5, coalesce(get(_p, k + 1), p + 5) - p)), 0L, (a, x) -> a + x)"
    return repeated.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", F.expr(covered).alias("n_repeat_words")
    )


# --- expressions shared with the SQL twin -------------------------------------------------


def vector_columns() -> list[str]:
    return [f"CAST(round({c} * {GRID}) AS BIGINT) AS q{i}" for i, c in zip(DIMS, COMPONENTS)]


def distance_columns() -> list[str]:
    """Forward substitution with the Cholesky factor; later columns use earlier ones."""
    out = []
    for i in DIMS:
        known = "".join(f" - l{i}{j} * y{j}" for j in DIMS if j < i)
        out.append(f"(q{i} - m{i}{known}) / l{i}{i} AS y{i}")
    return [*out, "y1 * y1 + y2 * y2 + y3 * y3 + y4 * y4 AS d2"]


BIN = "CAST(floor(8e0 * ln(d2 + 1e-3)) AS BIGINT)"


def sum_columns() -> list[str]:
    return [
        "count(*) AS n",
        *[f"CAST(sum(q{i}) AS DOUBLE) AS s{i}" for i in DIMS],
        *[f"CAST(sum(q{i} * q{j}) AS DOUBLE) AS s{i}{j}" for i, j in PAIRS],
    ]


def factor_columns() -> list[str]:
    """Centre and Cholesky factor from sums of the chosen bins."""
    out = [f"s{i} / n AS m{i}" for i in DIMS]
    for i, j in PAIRS:
        floor = f" + {(FLOORS[i - 1] * GRID) ** 2!r}e0" if i == j else ""
        out.append(f"(s{i}{j} / n - m{i} * m{j}) * {SCALE}e0{floor} AS c{i}{j}")
    for i in DIMS:
        for j in DIMS:
            if j > i:
                continue
            known = "".join(f" - l{i}{k} * l{j}{k}" for k in DIMS if k < j)
            out.append(f"sqrt(c{i}{i}{known}) AS l{i}{i}" if i == j else f"(c{i}{j}{known}) / l{j}{j} AS l{i}{j}")
    return out


MODEL = [f"m{i}" for i in DIMS] + [f"l{i}{j}" for i, j in PAIRS]
#: Root of the covariance determinant.
DETERMINANT = "l11 * l22 * l33 * l44"


def start_columns() -> list[str]:
    """First estimate: medians, and a diagonal of scaled median deviations."""
    factors = [
        f"greatest(1.4826e0 * a{i}, {FLOORS[i - 1] * GRID!r}e0) AS l{i}{i}" if i == j else f"0e0 AS l{i}{j}"
        for i, j in PAIRS
    ]
    return [*[f"m{i}" for i in DIMS], *factors]


# --- the operator ---------------------------------------------------------------------------


def _named(column: str) -> str:
    """A value or its absence as text that cannot be mistaken for another."""
    return f"coalesce(concat(length({column}), ':', {column}), '-')"


def fit_keys(rows: DataFrame) -> DataFrame:
    """(lang, source, key, pools): the estimate a group is judged by, and those its rows are part of."""
    own = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < LEAST_ROWS
    languages = own.groupBy("lang").agg(F.sum("n").alias("all"), F.bool_or(small).alias("wanting"))
    languages = languages.select(F.col("lang").alias("_l"), "all", "wanting")
    few = languages.agg(F.coalesce(F.bool_or(F.col("wanting") & (F.col("all") < LEAST_ROWS)), F.lit(False))).first()[0]
    joined = own.join(languages, F.col("lang").eqNullSafe(F.col("_l")))
    group, language = F.expr(f"concat('s', {_named('lang')}, {_named('source')})"), F.expr(f"concat('l', {_named('lang')})")
    enough = F.col("all") >= LEAST_ROWS
    key = F.when(~small, group).when(enough, language).otherwise("a")
    pools = F.array_compact(
        F.array(F.when(~small, group), F.when(F.col("wanting") & enough, language), F.lit("a" if few else None).cast("string"))
    )
    return joined.select("_l", F.col("source").alias("_s"), key.alias("key"), pools.alias("pools"))


def robust_distance(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """``rows`` (lang, source, four statistics, n_words) with ``d2``, the squared robust distance.

    Null where all rows together are fewer than ``LEAST_ROWS``. Estimates are tiny tables, written
    after each step, so the planner knows their size when it chooses between a broadcast and a
    shuffled join.
    """
    keys, _ = stored(fit_keys(rows), "keys")
    known = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))
    vectors, _ = stored(rows.join(keys, known).drop("_l", "_s").selectExpr("*", *vector_columns()), "vectors")
    members = vectors.select(F.explode("pools").alias("key"), *[f"q{i}" for i in DIMS])
    middle, _ = stored(
        members.groupBy("key").agg(F.count("*").alias("n"), *[F.median(f"q{i}").alias(f"m{i}") for i in DIMS])
        .where(F.col("n") >= LEAST_ROWS).drop("n"),
        "medians",
    )
    spread = members.join(middle, "key").groupBy("key", *[f"m{i}" for i in DIMS])
    spread = spread.agg(*[F.median(F.abs(F.col(f"q{i}") - F.col(f"m{i}"))).alias(f"a{i}") for i in DIMS])
    plain = members.groupBy("key").agg(*[F.expr(c) for c in sum_columns()]).where(F.col("n") >= LEAST_ROWS)
    starts = spread.selectExpr("1 AS fit", "key", *start_columns()).unionByName(
        plain.selectExpr("key", *factor_columns()).selectExpr("2 AS fit", "key", *MODEL)
    )
    model, _ = stored(starts, "estimate")
    for _ in range(steps):
        bins = members.join(model, "key").selectExpr("*", *distance_columns()).selectExpr("*", f"{BIN} AS bin")
        bins = bins.groupBy("fit", "key", "bin").agg(*[F.expr(c) for c in sum_columns()])
        nearer = "coalesce(sum(n) OVER (PARTITION BY fit, key ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
        chosen = bins.selectExpr("*", f"{nearer} AS nearer", "sum(n) OVER (PARTITION BY fit, key) AS every")
        chosen = chosen.where(F.expr(f"nearer < {SUPPORT}e0 * every"))
        sums = ["n", *[f"s{i}" for i in DIMS], *[f"s{i}{j}" for i, j in PAIRS]]
        added = chosen.groupBy("fit", "key").agg(*[F.sum(c).alias(c) for c in sums])
        model, _ = stored(added.selectExpr("fit", "key", *factor_columns()).select("fit", "key", *MODEL), "estimate")
    least = model.groupBy("key").agg(F.expr(f"min_by(struct({', '.join(MODEL)}), struct({DETERMINANT} AS d, fit)) AS best"))
    model, _ = stored(least.select("key", "best.*"), "estimate")
    return vectors.join(model, "key", "left").drop("pools").selectExpr("*", *distance_columns())


def quality_verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, statistics, ``base_failed``, ``distance`` and ``kept``.

    Null and blank texts have no words and fail the base rules. Null language or source is a
    value of its own. Estimates rest on all rows that pass the base rules; if these are fewer
    than ``LEAST_ROWS``, nothing more is rejected. Repeated rows each get
    a verdict, long texts are read whole, other columns are ignored.
    """
    named = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
        F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    kept = tuple(f"_keep_{c}" for c in keep)
    rows, _ = stored(text_statistics(named, "_text", ("_id", "lang", "source", *kept)), "statistics")
    rows = rows.withColumn("base_failed", F.expr(BASE_FAILED))
    passed = robust_distance(rows.where(~F.col("base_failed")))
    out = passed.select(*rows.columns, "d2").unionByName(
        rows.where("base_failed").withColumn("d2", F.lit(None).cast("double"))
    )
    return out.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", F.sqrt("d2").alias("distance"),
        (~F.col("base_failed") & (F.col("d2").isNull() | (F.col("d2") <= CUTOFF))).alias("kept"),
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
    )


def _sql() -> str:
    distance = ", ".join(distance_columns())
    factors = ", ".join(factor_columns())
    sums = ", ".join(f"sum({c}) AS {c}" for c in ["n", *[f"s{i}" for i in DIMS], *[f"s{i}{j}" for i, j in PAIRS]])
    steps, model = "", "est0"
    for k in range(1, STEPS + 1):
        steps += f""",
bins{k} AS (SELECT fit, key, {BIN} AS bin, {", ".join(sum_columns())}
  FROM (SELECT *, {distance} FROM members JOIN {model} USING (key)) GROUP BY fit, key, bin),
near{k} AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY fit, key ORDER BY bin
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nearer, sum(n) OVER (PARTITION BY fit, key) AS every
  FROM bins{k}),
est{k} AS (SELECT fit, key, {", ".join(MODEL)} FROM (SELECT *, {factors} FROM (
  SELECT fit, key, {sums} FROM near{k} WHERE nearer < {SUPPORT}e0 * every GROUP BY fit, key)))"""
        model = f"est{k}"
    medians = ", ".join(f"quantile_cont(q{i}, 0.5) AS m{i}" for i in DIMS)
    deviations = ", ".join(f"quantile_cont(abs(q{i} - m{i}), 0.5) AS a{i}" for i in DIMS)
    centre, qs = ", ".join(f"m{i}" for i in DIMS), ", ".join(f"q{i}" for i in DIMS)
    return f"""WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines,
         row_number() OVER () AS r
  FROM documents),
windows AS (
  SELECT r, unnest(range(1, len(w) - 3)) AS p, w FROM split WHERE len(w) >= 5),
named AS (SELECT r, p, list_slice(w, p, p + 4) AS g FROM windows),
twice AS (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM named),
covered AS (SELECT r, count(DISTINCT p + k) AS n FROM twice, range(5) t(k) WHERE c > 1 GROUP BY r),
stats AS (
  SELECT s.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN covered USING (r)),
judged AS (SELECT *, {BASE_FAILED} AS base_failed FROM stats),
passed AS (SELECT * FROM judged WHERE NOT base_failed),
own AS (SELECT lang, source, count(*) AS n FROM passed GROUP BY ALL),
tongues AS (SELECT lang, sum(n) AS whole, bool_or(n < {LEAST_ROWS}) AS wanting FROM own GROUP BY lang),
few AS (SELECT coalesce(bool_or(wanting AND whole < {LEAST_ROWS}), false) AS f FROM tongues),
keys AS (SELECT own.lang, source, n, whole, wanting,
    concat('s', {_named("own.lang")}, {_named("source")}) AS g, concat('l', {_named("own.lang")}) AS t
  FROM own JOIN tongues ON own.lang IS NOT DISTINCT FROM tongues.lang),
vectors AS (SELECT p.*, CASE WHEN n >= {LEAST_ROWS} THEN g WHEN whole >= {LEAST_ROWS} THEN t ELSE 'a' END AS key,
    n, whole, wanting, g, t, {", ".join(vector_columns())}
  FROM passed p JOIN keys k ON p.lang IS NOT DISTINCT FROM k.lang AND p.source IS NOT DISTINCT FROM k.source),
members AS (
  SELECT g AS key, {qs} FROM vectors WHERE n >= {LEAST_ROWS}
  UNION ALL SELECT t, {qs} FROM vectors WHERE wanting AND whole >= {LEAST_ROWS}
  UNION ALL SELECT 'a', {qs} FROM vectors, few WHERE f),
middle AS (SELECT key, {medians} FROM members GROUP BY key HAVING count(*) >= {LEAST_ROWS}),
spread AS (SELECT key, {centre}, {deviations} FROM members JOIN middle USING (key) GROUP BY key, {centre}),
est0 AS (SELECT 1 AS fit, key, {", ".join(start_columns())} FROM spread
  UNION ALL SELECT 2, key, {", ".join(MODEL)} FROM (SELECT *, {factors} FROM (
    SELECT key, {", ".join(sum_columns())} FROM members GROUP BY key HAVING count(*) >= {LEAST_ROWS}))){steps},
best AS (SELECT * FROM {model} QUALIFY row_number() OVER (PARTITION BY key ORDER BY {DETERMINANT}, fit) = 1),
far AS (SELECT r, d2 FROM (SELECT *, {distance} FROM vectors JOIN best USING (key)) WHERE d2 > {CUTOFF}e0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND d2 IS NULL AS kept
FROM judged LEFT JOIN far USING (r)"""


SQL = _sql()
