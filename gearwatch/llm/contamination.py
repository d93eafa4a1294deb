"""Benchmark decontamination: a broadcast hash table of benchmark windows, met by text windows.

Every word of a text is a possible start of a window. Three words of the window make a key; rows
whose key is in the table compare the whole window. One scan, no shuffle before the hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import stored

WINDOW = 13
#: Share of words that must be hit, as one in so many.
ONE_IN = 20
#: Benchmark windows that may be broadcast (about 250 bytes each); beyond, the join is shuffled.
BROADCAST_WINDOWS = 500_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column | str) -> Column:
    """Words of letters, digits and all characters beyond ASCII, A-Z lower-cased; null has none."""
    column = F.col(text) if isinstance(text, str) else text
    lowered = F.translate(F.coalesce(column, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, BETWEEN), "")


def _key(length: int | Column, first: Column, middle: Column, last: Column) -> Column:
    return F.xxhash64(F.lit(length) if isinstance(length, int) else length, first, middle, last)


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(len, key, gram, items): the distinct windows of all items. A short item is one window."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), plain_words(text_col).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(window)))
    grams = items.select("item", "len", F.explode(F.expr("transform(sequence(1, size(w) - len + 1), i -> slice(w, i, len))")).alias("g"))
    return grams.groupBy("len", "g").agg(F.collect_set("item").alias("items")).select(
        "len",
        _key(F.col("len"), F.get("g", F.lit(0)), F.expr("get(g, len div 2)"), F.expr("get(g, len - 1)")).alias("key"),
        F.array_join("g", " ").alias("gram"),
        "items",
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, spans of hit windows, n_hit, items, contaminated.

    ``spans`` are (start word, words) of windows that occur in the benchmark, ``items`` the ids
    of items with such a window, sorted as strings. Contaminated: at least one hit and at least
    one word in twenty. Null, blank and wordless texts have no words and no hits; so do items. An
    item without an id makes hits but is not listed. Repeated rows each get a row; texts are
    read whole, other columns ignored. An empty benchmark hits nothing.
    """
    windows, _ = stored(benchmark_windows(benchmark, item_col, item_text_col, window), "windows")
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())  # at most ``window`` numbers
    fits = windows.count() <= BROADCAST_WINDOWS
    if fits:
        windows = F.broadcast(windows)
    named = [F.col(c).alias(f"_keep_{c}") for c in keep]
    kept = [f"_keep_{c}" for c in keep]
    split = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), *named, plain_words(text_col).alias("_w")
    )
    # One struct per word with the words a key needs; the first struct stands for the text itself.
    offsets = sorted({0} | {o for n in lengths for o in (n // 2, n - 1)})
    shifted = [F.slice("_w", o + 1, F.greatest(F.size("_w") - o, F.lit(0))).alias(f"o{o}") for o in offsets]
    ahead = split.select("_row", "_id", *kept, F.size("_w").cast("long").alias("n_words"), "_w", *shifted)
    zipped = F.arrays_zip(*[f"o{o}" for o in offsets])
    nothing = F.struct(*[F.lit(None).cast("string").alias(f"o{o}") for o in offsets])
    starts = ahead.select("_row", "_id", *kept, "n_words", "_w", F.posexplode(F.concat(F.array(nothing), zipped)).alias("_pos", "_o"))
    tries = [
        F.struct(
            F.lit(n).alias("len"),
            F.when(F.col(f"_o.o{n - 1}").isNotNull(), _key(n, F.col("_o.o0"), F.col(f"_o.o{n // 2}"), F.col(f"_o.o{n - 1}"))).alias("key"),
        )
        for n in lengths
    ]
    if len(tries) == 1:
        starts = starts.withColumn("_try", tries[0])
    elif tries:
        starts = starts.withColumn("_try", F.explode(F.array(*tries)))
    else:
        starts = starts.withColumn("_try", F.struct(F.lit(0).alias("len"), F.lit(None).cast("long").alias("key")))
    # Words are only put together where a key is met: the length is that of the window met.
    own = F.array_join(F.slice("_w", F.col("_pos"), F.col("len")), " ")
    if not fits:
        # The words of a window travel with its key, the array of a whole text does not.
        said = F.array_join(F.slice("_w", F.col("_pos"), F.col("_try.len")), " ")
        starts = starts.withColumn("_own", F.when(F.col("_try.key").isNotNull(), said)).drop("_w", "_o")
        own = F.col("_own")
    met = starts.join(windows, (F.col("_try.key") == F.col("key")) & (own == F.col("gram")), "left").where(
        (F.col("_pos") == 0) | F.col("gram").isNotNull()
    )
    hit = F.when(F.col("gram").isNotNull(), F.struct((F.col("_pos") - 1).alias("start"), F.col("len").alias("n")))
    found = met.select("_row", "_id", *kept, "n_words", hit.alias("hit"), "items").groupBy("_row").agg(
        F.first("_id").alias(id_col),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_set("hit")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        *[F.first(c).alias(c) for c in kept],
    )
    covered = "size(array_distinct(flatten(transform(spans, s -> sequence(s.start, s.start + s.n - 1)))))"
    measured = found.withColumn("n_hit", F.expr(covered).cast("long"))
    judged = (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))
    return measured.select(
        id_col, "n_words", "spans", "n_hit", "items", judged.alias("contaminated"),
        *[F.col(k).alias(c) for k, c in zip(kept, keep)],
    )


def without_spans(words_col: str, spans_col: str) -> Column:
    """Text of the words outside all spans, joined by one space."""
    return F.expr(
        f"array_join(filter({words_col}, (w, i) -> NOT exists({spans_col}, s -> i >= s.start AND i < s.start + s.n)), ' ')"
    )


SQL = f"""WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(len(w), {WINDOW}) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
starts AS (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM items),
grams AS (SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS gram FROM starts),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM grams),
places AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, lengths WHERE len(w) >= n),
hits AS (
  SELECT r, p, g.n, item FROM (
    SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS gram FROM places JOIN docs USING (r)) d
  JOIN grams g ON d.gram = g.gram AND d.n = g.n),
covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {ONE_IN} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""
