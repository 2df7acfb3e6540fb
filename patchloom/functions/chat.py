"""Chat layouts and their rendered text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions.text import is_blank

# Turn markers of the rendered text.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
RESPONSE_ROLE = "assistant"
# Fixed value: role names of the "from" field.
ROLE_NAMES = {"human": "user", "gpt": "assistant"}
LAYOUTS = ("messages", "sharegpt", "alpaca")
# Formats of a wrapped assistant action, by style.
ACTION_STYLES = ("xml", "ticks", "tool")


def turn_text(role: Column, content: Column) -> Column:
    """One rendered turn."""
    role, content = F.coalesce(role, F.lit("")), F.coalesce(content, F.lit(""))
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), content, F.lit(TURN_END))


def effort_line(reasoning_effort: str | None) -> str:
    """The optional leading turn that states how much to reason."""
    if not reasoning_effort:
        return ""
    return f"{TURN_START}system\nReasoning: {reasoning_effort}{TURN_END}"


def render_messages(messages: Column, reasoning_effort: str | None = None) -> Column:
    """Text of a messages array; null messages render as the empty conversation."""
    turns = F.transform(messages, lambda m: turn_text(m["role"], m["content"]))
    return F.concat(F.lit(effort_line(reasoning_effort)), F.coalesce(F.array_join(turns, ""), F.lit("")))


def to_messages(df: DataFrame, layout: str) -> DataFrame:
    """Add ``messages`` (role, content) from another chat layout; source columns are dropped."""
    if layout == "messages":
        return df
    if layout == "sharegpt":
        names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
        messages = F.transform(
            "conversations",
            lambda c: F.struct(
                F.coalesce(F.try_element_at(names, c["from"]), c["from"]).alias("role"),
                c["value"].alias("content"),
            ),
        )
        return df.withColumn("messages", messages).drop("conversations")
    if layout == "alpaca":
        asked = F.coalesce("instruction", F.lit(""))
        user = F.when(is_blank(F.col("input")), asked).otherwise(
            F.concat(asked, F.lit("\n\n"), F.col("input"))
        )
        messages = F.array(
            F.struct(F.lit("user").alias("role"), user.alias("content")),
            F.struct(F.lit(RESPONSE_ROLE).alias("role"), F.coalesce("output", F.lit("")).alias("content")),
        )
        return df.withColumn("messages", messages).drop("instruction", "input", "output")
    raise ValueError(f"unknown layout {layout!r}; known: {', '.join(LAYOUTS)}")


def action_text(text: Column, style: str) -> Column:
    """An assistant action as a tag, a code fence or a JSON call."""
    if style == "xml":
        return F.concat(F.lit("<action>"), text, F.lit("</action>"))
    if style == "ticks":
        return F.concat(F.lit("```\n"), text, F.lit("\n```"))
    if style == "tool":
        call = F.struct(F.lit("run").alias("tool"), F.struct(text.alias("command")).alias("arguments"))
        return F.to_json(call)
    raise ValueError(f"unknown style {style!r}; known: {', '.join(ACTION_STYLES)}")


def render_actions(df: DataFrame, style: str, *, role: str = "role", text: str = "text") -> DataFrame:
    """Wrap the text of assistant turns in the given action style."""
    return df.withColumn(
        text,
        F.when(F.col(role) == RESPONSE_ROLE, action_text(F.col(text), style)).otherwise(F.col(text)),
    )
