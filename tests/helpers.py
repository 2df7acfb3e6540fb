"""Small helpers for tests."""


def column(spark, values, fn, type_="string"):
    """Apply a Column function to a list of values, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {type_}")
    from pyspark.sql import functions as F

    rows = df.select("i", fn(F.col("x")).alias("y")).collect()
    return [r.y for r in sorted(rows, key=lambda r: r.i)]


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_null_last)


def _null_last(row):
    return [(v is None, v) for v in row]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
