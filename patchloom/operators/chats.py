"""Conversations as tables of turns: rendering, spans, step caps, quality, selection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.functions.chat import RESPONSE_ROLE, TURN_START, effort_line, turn_text
from patchloom.operators.scans import lookup_join, running

# Agent step cap; data set size classes and the least useful size.
STEP_CAP = 25
SMALL_BELOW, LARGE_ABOVE, MINIMUM = 300, 999, 100
# Turns that one window sums up; more are added up block by block.
BLOCK_TURNS = 4096


def collect_turns(
    turns: DataFrame,
    item: Column,
    out: str,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
) -> DataFrame:
    """Gather an item per turn into one ordered array per conversation, whatever its length.

    One row is one training example, so a conversation too large for a row fails loudly;
    ``rendered_turns`` is the form for those.
    """
    placed = turns.select(conv, F.struct(F.col(turn).alias("_t"), item.alias("_x")).alias("_s"))
    gathered = placed.groupBy(conv).agg(F.sort_array(F.collect_list("_s")).alias("_all"))
    return gathered.select(conv, F.col("_all._x").alias(out))


def render_chat(
    turns: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    reasoning_effort: str | None = None,
) -> DataFrame:
    """The rendered text of each conversation, without a generation prompt: one row each."""
    pieces = collect_turns(turns, turn_text(F.col(role), F.col(text)), "_pieces", conv=conv, turn=turn)
    head = F.lit(effort_line(reasoning_effort))
    return pieces.select(conv, F.concat(head, F.array_join("_pieces", "")).alias(text))


def rendered_turns(
    turns: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    reasoning_effort: str | None = None,
) -> DataFrame:
    """The rendered conversation in long form: one row per turn, with its start in the whole.

    For conversations of any size; the effort line comes before the first start.
    """
    piece = turn_text(F.col(role), F.col(text))
    pieces = turns.select(conv, turn, piece.alias(text), F.char_length(piece).cast("bigint").alias("_len"))
    block = F.floor(F.col(turn) / BLOCK_TURNS)
    placed = running(pieces, [conv], [turn], block, {"_at": ("sum", F.col("_len"))}, inclusive=False)
    return placed.select(conv, turn, (F.col("_at") + len(effort_line(reasoning_effort))).alias("start"), text)


def completion_spans(
    turns: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    reasoning_effort: str | None = None,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """Character start and end of each assistant body in the whole rendered conversation.

    Only lengths are shuffled, never the texts.
    """
    body = F.char_length(F.coalesce(text, F.lit("")))
    lengths = turns.select(
        conv,
        turn,
        role,
        body.cast("bigint").alias("_body"),
        F.char_length(turn_text(F.col(role), F.col(text))).cast("bigint").alias("_len"),
    )
    block = F.floor(F.col(turn) / block_turns)
    placed = running(lengths, [conv], [turn], block, {"_at": ("sum", F.col("_len"))}, inclusive=False)
    head = len(effort_line(reasoning_effort)) + len(f"{TURN_START}{RESPONSE_ROLE}\n")
    start = F.col("_at") + head
    return placed.where(F.col(role) == RESPONSE_ROLE).select(
        conv, turn, start.alias("start"), (start + F.col("_body")).alias("end")
    )


def masked_share(
    turns: DataFrame,
    *,
    conv: str = "conv_id",
    role: str = "role",
    text: str = "text",
    reasoning_effort: str | None = None,
) -> DataFrame:
    """Per conversation, the share of rendered characters that carry no loss."""
    body = F.char_length(F.coalesce(text, F.lit("")))
    whole = F.char_length(turn_text(F.col(role), F.col(text)))
    kept = F.coalesce(F.sum(F.when(F.col(role) == RESPONSE_ROLE, body)), F.lit(0))
    chars = F.sum(whole) + len(effort_line(reasoning_effort))
    return turns.groupBy(conv).agg(
        chars.alias("chars"), kept.alias("trained_chars"), (1 - kept / chars).alias("masked_share")
    )


def limit_steps(
    turns: DataFrame, n: int = STEP_CAP, *, conv: str = "conv_id", turn: str = "turn"
) -> DataFrame:
    """The first n turns of each trace, with a flag on traces that had more.

    Rows beyond n + 1 are cut by a literal row-number limit before the shuffle, so the
    flag is read from at most n + 1 rows per trace.
    """
    by_turn = Window.partitionBy(conv).orderBy(turn)
    kept = turns.withColumn("_rn", F.row_number().over(by_turn)).where(F.col("_rn") <= n + 1)
    flagged = kept.withColumn("truncated", F.max("_rn").over(Window.partitionBy(conv)) > n)
    return flagged.where(F.col("_rn") <= n).drop("_rn")


def select_resolved(traj: DataFrame, reports: DataFrame, on: str = "conv_id") -> DataFrame:
    """Traces whose report says resolved."""
    return lookup_join(traj, reports.where("resolved").select(on).distinct(), [on], "left_semi")


def select_failed(traj: DataFrame, reports: DataFrame, on: str = "conv_id") -> DataFrame:
    """All other traces: reported unresolved, without a verdict, or without a report."""
    return lookup_join(traj, reports.where("resolved").select(on).distinct(), [on], "left_anti")


def answered_ids(turns: DataFrame, *, conv: str = "conv_id", role: str = "role") -> DataFrame:
    """Ids of conversations with at least one assistant turn."""
    return turns.where(F.col(role) == RESPONSE_ROLE).select(conv).distinct()


def answered(turns: DataFrame, *, conv: str = "conv_id", role: str = "role") -> DataFrame:
    """Conversations with at least one assistant turn."""
    return lookup_join(turns, answered_ids(turns, conv=conv, role=role), [conv], "left_semi")


def quality_filter(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows no rule removes. A rule is a condition for removal; null counts as false."""
    out = df
    for bad in rules.values():
        out = out.where(~F.coalesce(bad, F.lit(False)))
    return out


def quality_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Per rule, how many rows it hits and how many it is the first to remove.

    One pass over the data for all rules.
    """
    hits = {name: F.coalesce(bad, F.lit(False)) for name, bad in rules.items()}
    aggs, before = [F.count("*").alias("_rows")], F.lit(False)
    for name, hit in hits.items():
        aggs += [F.count_if(hit).alias(f"{name}_hit"), F.count_if(hit & ~before).alias(f"{name}_removed")]
        before = before | hit
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"{name}_hit").alias("hits"),
                F.col(f"{name}_removed").alias("removed"),
            )
            for name in hits
        ]
    )
    return wide.select(F.col("_rows").alias("rows"), F.inline(rows))


def dataset_profile(df: DataFrame, file: Column | None = None) -> DataFrame:
    """Examples, source files, size class, and whether the set is under the minimum."""
    where = F.col("_metadata.file_path") if file is None else file
    n = F.col("examples")
    return (
        df.select(where.alias("_file"))
        .groupBy("_file")
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("examples"), F.count("_file").alias("files"))
        .withColumns(
            {
                "size_class": F.when(n < SMALL_BELOW, "small").when(n > LARGE_ABOVE, "large").otherwise("medium"),
                "under_minimum": n < MINIMUM,
            }
        )
    )
