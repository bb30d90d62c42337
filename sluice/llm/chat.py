"""Multi-party dialogues as training text, once from each speaker's side.

Every speaker of a dialogue gets a rendering with themself as the assistant and
the others as named users; the loss mask covers that speaker's words alone. The
result has one row per message and side, with the message's place in the whole
rendering, so no row and no task holds a dialogue. DataFrame functions only.

Places come from two levels of running sums: within blocks of ``BLOCK_TURNS``
turn numbers, and over the blocks of a dialogue. A dialogue with very many
turns is thus spread over many groups, and the texts are shuffled once, by
dialogue and block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers in one group of the running sums.
BLOCK_TURNS = 512

# Markup of a message (fixed values): <|im_start|>who\ntext<|im_end|>\n
OPEN, CLOSE, NEWLINE = "<|im_start|>", "<|im_end|>", "\n"
SYSTEM, ASSISTANT, NAMELESS = "system", "assistant", "unknown"


def _heading(speaker: Column, side: Column) -> Column:
    who = (
        F.when(speaker == SYSTEM, F.lit(SYSTEM)).when(speaker == side, F.lit(ASSISTANT)).otherwise(F.concat(F.lit("user name="), speaker))
    )
    return F.concat(F.lit(OPEN), who, F.lit(NEWLINE))


def perspectives(
    messages: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, perspective, position, turn, speaker, rendered, start_char, train,
    mask_start, mask_end), one row per message and side.

    Joining ``rendered`` by ``position`` gives the dialogue as ``perspective``
    sees it; ``start_char`` is where the row begins in it, and characters
    [mask_start, mask_end) (null where ``train`` is false) bear the loss: the
    words of that speaker and their closing mark.

    Messages are ordered by turn (nulls first), speaker and text; a message
    given twice is rendered twice. A null or empty speaker is called "unknown";
    a null text is empty. System messages are nobody's side: a dialogue without
    other speakers has no rows. Rows with a null conversation form one
    dialogue. Other columns play no part.
    """
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`").cast("long")
    m = messages.select(
        conv.alias("conv"),
        # Keys without nulls, so that one shuffle serves every step below.
        F.coalesce(conv.cast("string"), F.lit("")).alias("key"),
        conv.isNull().alias("no_key"),
        F.coalesce(F.floor(turn / BLOCK_TURNS), F.lit(-(2**62))).alias("block"),
        turn.alias("turn"),
        F.coalesce(F.nullif(F.col(f"`{speaker_col}`").cast("string"), F.lit("")), F.lit(NAMELESS)).alias("speaker"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    group = ["key", "no_key", "block"]
    m = m.repartition(*[F.col(c) for c in group])

    # Sizes of the blocks as each side sees them: a row per block and speaker.
    sizes = m.groupBy(*group, "speaker").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    sides = sizes.where(F.col("speaker") != SYSTEM).select("key", "no_key", F.col("speaker").alias("perspective")).distinct()
    around = F.length(_heading(F.col("speaker"), F.col("perspective"))) + len(CLOSE + NEWLINE)
    blocks = sizes.join(sides, ["key", "no_key"]).groupBy(*group, "perspective").agg(
        F.sum("n").alias("n"), F.sum(F.col("chars") + F.col("n") * around).alias("chars")
    )
    before = Window.partitionBy("key", "no_key", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        *group,
        F.struct(
            "perspective",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
            F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"),
        ).alias("side"),
    ).groupBy(*group).agg(F.collect_list("side").alias("sides"))  # one entry per speaker

    rows = m.join(starts, group).withColumn("side", F.explode("sides")).select(*m.columns, "side.*")
    rows = rows.withColumn("heading", _heading(F.col("speaker"), F.col("perspective"))).withColumn(
        "rendered", F.concat("heading", "text", F.lit(CLOSE + NEWLINE))
    )
    in_block = Window.partitionBy(*group, "perspective").orderBy(F.asc_nulls_first("turn"), "speaker", "text")
    earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("n_here", F.row_number().over(in_block) - 1).withColumn(
        "chars_here", F.coalesce(F.sum(F.length("rendered")).over(earlier), F.lit(0))
    )
    start = F.col("chars_before") + F.col("chars_here")
    train = F.col("speaker") == F.col("perspective")
    first = start + F.length("heading")
    return placed.select(
        F.col("conv").alias(conv_col),
        "perspective",
        (F.col("n_before") + F.col("n_here")).cast("long").alias("position"),
        F.col("turn").alias(turn_col),
        "speaker",
        "rendered",
        start.cast("long").alias("start_char"),
        train.alias("train"),
        F.when(train, first.cast("long")).alias("mask_start"),
        F.when(train, (first + F.length("text") + len(CLOSE)).cast("long")).alias("mask_end"),
    )
