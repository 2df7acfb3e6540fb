"""User-written rewards and formatters, run on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

RewardFn = Callable[..., Sequence[float | None]]


def register_reward(
    spark: SparkSession, name: str, fn: RewardFn, **kwargs
) -> Callable[[Column], Column]:
    """Turn a batch reward ``fn(completions, **kwargs)`` into a column function.

    It is also registered for SQL under ``name``. The function sees one Arrow batch at a
    time and must give one reward per completion; None stays null.
    """

    def rewards(completions: pd.Series) -> pd.Series:
        values = list(fn(completions.tolist(), **kwargs))
        if len(values) != len(completions):
            raise ValueError(f"{name}: {len(values)} rewards for {len(completions)} completions")
        return pd.Series(values, dtype="float64")

    udf = F.pandas_udf(rewards, T.DoubleType())
    spark.udf.register(name, udf)
    return udf


def map_examples(df: DataFrame, fn: Callable[[dict], dict], schema: str | T.StructType) -> DataFrame:
    """Apply a per-example formatter. New fields are added to the example's own.

    ``schema`` lists the output columns, kept or new.
    """
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out)
        for batch in batches:
            rows = [{**example, **fn(example)} for example in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in arrow.names} for r in rows], arrow)

    return df.mapInArrow(run, out)
