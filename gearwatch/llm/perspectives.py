"""Chat formatting from every participant's point of view.

In the dialogue of one participant that speaker is the assistant, the others are users with their
names, and only the speaker's own words are trained on. The result has one row per turn and point
of view, with the place of its text in the dialogue; the rows of a dialogue in order of ``position``
are the dialogue. So a conversation of any length never has to fit in one row or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Markers of a turn (fixed by the chat format).
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: The role that sets the scene and takes no part.
SCENE = "system"
NOBODY = "unknown~"
#: What would break the format, and the sign before a mark.
BREAKING, MARK = r"[\x00-\x20<>|=~]+", "~"
#: Turn numbers that are added up in one window; blocks of a long conversation are added up apart.
BLOCK = 256


def speaker_name(role: Column) -> Column:
    """A role as a name that cannot break the format, different for different roles.

    A role that has to be changed gets a mark of the whole role, after a sign no unchanged role has.
    Null and blank are one unknown speaker.
    """
    cleaned = F.regexp_replace(F.trim(role), BREAKING, "_")
    marked = F.concat(cleaned, F.lit(MARK), F.substring(F.sha2(role, 256), 1, 16))
    blank = F.coalesce(F.trim(F.regexp_replace(role, BREAKING, " ")) == "", F.lit(True))
    return F.when(blank, F.lit(NOBODY)).when(F.trim(role) == SCENE, F.lit(SCENE)).when(cleaned == role, role).otherwise(marked)


def perspectives(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conversation, perspective, turn, speaker, position, segment, start, end, train_start, train_end).

    ``segment`` is the rendered turn, at characters ``start`` to ``end`` of the dialogue; the mask
    is ``train_start`` to ``train_end``, the speaker's text with its closing marker, null for
    turns of others. Turns are ordered by number (missing ones last), then speaker and text; repeated
    rows are repeated turns. Null text is empty; markers inside texts are broken up. Rows without a
    conversation form one. A conversation of the scene alone has no participant and no rows. Other
    columns are ignored. Turns of one number stay together; everything else of a conversation is
    added up in blocks.
    """
    named = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        speaker_name(F.col(role_col)).alias("speaker"),
        F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|im_"), F.lit("<| im_")).alias("said"),
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(2**62)))
    parties = named.where(F.col("speaker") != SCENE).select(F.col("conv").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    seen = named.join(parties, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = F.col("speaker") == F.col("perspective")
    head = (
        F.when(own, F.lit(f"{OPEN}assistant\n"))
        .when(F.col("speaker") == SCENE, F.lit(f"{OPEN}system\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), "speaker", F.lit("\n")))
    )
    shown = seen.select(
        "conv", "perspective", "turn", "block", "speaker", own.alias("own"), head.alias("head"),
        F.concat("said", F.lit(CLOSE)).alias("body"),
    )
    shown = shown.withColumn("segment", F.concat("head", "body", F.lit("\n"))).withColumn("n", F.length("segment").cast("long"))

    totals = shown.groupBy("conv", "perspective", "block").agg(F.sum("n").alias("chars"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("conv", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("conv").alias("_c"), F.col("perspective").alias("_p"), F.col("block").alias("_b"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    within = Window.partitionBy("conv", "perspective", "block").orderBy(F.asc_nulls_last("turn"), "speaker", "body")
    inside = shown.select(
        "*",
        F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.row_number().over(within).alias("_row"),
    )
    placed = inside.join(
        before, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p")) & (F.col("block") == F.col("_b"))
    )
    end = F.col("chars_before") + F.col("_upto")
    start = end - F.col("n")
    return placed.select(
        F.col("conv").alias(conv_col), "perspective", F.col("turn").alias(turn_col), "speaker",
        (F.col("rows_before") + F.col("_row")).cast("long").alias("position"),
        "segment", start.alias("start"), end.alias("end"),
        F.when(F.col("own"), start + F.length("head")).alias("train_start"),
        F.when(F.col("own"), end - 1).alias("train_end"),
    )


SQL = f"""WITH named AS (
  SELECT conv_id, turn, replace(coalesce(text, ''), '<|im_', '<| im_') AS said,
         CASE WHEN coalesce(trim(regexp_replace(role, '{BREAKING}', ' ', 'g')), '') = '' THEN '{NOBODY}'
              WHEN trim(role) = '{SCENE}' THEN '{SCENE}'
              WHEN regexp_replace(trim(role), '{BREAKING}', '_', 'g') = role THEN role
              ELSE regexp_replace(trim(role), '{BREAKING}', '_', 'g') || '{MARK}' || substr(sha256(role), 1, 16) END AS speaker
  FROM conversations),
parties AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM named WHERE speaker <> '{SCENE}'),
shown AS (
  SELECT conv_id, perspective, turn, speaker, said,
         CASE WHEN speaker = perspective THEN '{OPEN}assistant' || chr(10)
              WHEN speaker = '{SCENE}' THEN '{OPEN}system' || chr(10)
              ELSE '{OPEN}user name=' || speaker || chr(10) END AS head
  FROM named JOIN parties ON conv_id IS NOT DISTINCT FROM c),
long AS (SELECT *, head || said || '{CLOSE}' || chr(10) AS segment FROM shown),
placed AS (
  SELECT *, CAST(sum(length(segment)) OVER w AS BIGINT) AS upto, row_number() OVER w AS position FROM long
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, said || '{CLOSE}'
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, perspective, turn, speaker, position, segment, CAST(upto - length(segment) AS BIGINT) AS start,
       upto AS "end",
       CAST(CASE WHEN speaker = perspective THEN upto - length(segment) + length(head) END AS BIGINT) AS train_start,
       CAST(CASE WHEN speaker = perspective THEN upto - 1 END AS BIGINT) AS train_end
FROM placed"""
