"""Text helpers: Column to Column, evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.strip() removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Caps and markers used when long text is cut.
TRACE_CAP = 4000
FEEDBACK_CAP = 200_000
MIDDLE_MARK = "\n... [truncated] ...\n"
TAIL_MARK = "\n... [truncated]"
# Where a side record keeps the agent's trace.
TRACE_OUTPUTS, TRACE_TEXT = "Generated Outputs", "Agent Trace"

# The sequence lengths the training recipes use.
SEQ_LIMITS = (8192, 10240, 16384, 32768)


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace the way Python's strip() does."""
    return F.btrim(col, F.lit(PYTHON_WHITESPACE))


def is_blank(col: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(col), F.lit("")) == ""


def truncate_middle(col: Column, cap: int = TRACE_CAP) -> Column:
    """Keep the first and last cap/2 characters of text longer than cap."""
    half = cap // 2
    return F.when(
        F.char_length(col) > cap,
        F.concat(F.left(col, F.lit(half)), F.lit(MIDDLE_MARK), F.right(col, F.lit(half))),
    ).otherwise(col)


def cut_trace(info: Column, cap: int = TRACE_CAP) -> Column:
    """A side record with the agent's trace inside it cut in the middle; nothing else changes.

    The record is a struct that holds the struct ``TRACE_OUTPUTS`` with the text ``TRACE_TEXT``.
    A null record, or one without outputs or trace, stays as it is.
    """
    outputs = info[TRACE_OUTPUTS]
    trace = truncate_middle(outputs[TRACE_TEXT], cap)
    cut = info.withField(f"`{TRACE_OUTPUTS}`", outputs.withField(f"`{TRACE_TEXT}`", trace))
    return F.when(outputs[TRACE_TEXT].isNotNull(), cut).otherwise(info)


def cap_text(col: Column, cap: int = FEEDBACK_CAP) -> Column:
    """Keep the first cap characters of longer text and mark the cut."""
    return F.when(
        F.char_length(col) > cap, F.concat(F.left(col, F.lit(cap)), F.lit(TAIL_MARK))
    ).otherwise(col)


def est_tokens(col: Column) -> Column:
    """Token estimate: a quarter of the characters, rounded up."""
    return F.ceil(F.char_length(col) / 4).cast("bigint")


def word_count(col: Column) -> Column:
    """Runs of non-whitespace; 0 for blank text."""
    return F.regexp_count(col, F.lit(r"\S+")).cast("bigint")


def length_stats(
    df: DataFrame, text: str = "text", limits: Sequence[int] = SEQ_LIMITS
) -> DataFrame:
    """Add characters, words, estimated tokens and one over-limit flag per limit."""
    col = F.col(text)
    out = df.withColumns(
        {
            "chars": F.char_length(col).cast("bigint"),
            "words": word_count(col),
            "est_tokens": est_tokens(col),
        }
    )
    return out.withColumns({f"over_{n}": F.col("est_tokens") > n for n in limits})


def split_paragraphs(df: DataFrame, body: str = "body", out: str = "text") -> DataFrame:
    """One row per non-blank paragraph of ``body``, with its place in the body."""
    rest = [c for c in df.columns if c != body]
    parts = df.select(*rest, F.posexplode(F.split(F.col(body), "\n\n")).alias("position", out))
    return (
        parts.withColumn(out, strip(F.col(out)))
        .where(F.col(out) != "")
        .withColumn("position", F.col("position").cast("bigint"))
    )
