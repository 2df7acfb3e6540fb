"""Whitening of embeddings: blockwise QR of centred rows, then the singular values of R."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.bidiagonal import right_singular
from patchloom.llm.common import prepared, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
FOLDED = 32  # partial results that one task joins to one
BLOCK_ROWS = 4096  # rows put below R at a time
_LARGEST = 2.0**62


def _valid(batch: pa.RecordBatch, column: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch by vector length: (row numbers, integer vectors) of those that count."""
    lists = batch.column(column)
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * values) + SHIFT
        bad = ~(np.abs(x) < _LARGEST)  # true for what is not a number as well
    ends = np.cumsum(size)
    before = np.concatenate([[0], np.cumsum(bad)])
    fine = (size > 0) & (before[ends] == before[ends - size])
    out = {}
    for d in np.unique(size[fine]).tolist():
        rows = np.flatnonzero(fine & (size == d))
        out[d] = rows, x[(ends[rows] - d)[:, None] + np.arange(d)].astype(np.int64)
    return out


def _centred(x: np.ndarray, n: int, sums: list[int], small: bool) -> np.ndarray:
    """n * x - S exactly: 64-bit integers where they suffice, else Python's."""
    if small:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _deviations(centred: np.ndarray) -> pa.Array:
    """Exact sums of squares per row, as decimals."""
    most = max((abs(int(v)) for v in (centred.max(initial=0), centred.min(initial=0))), default=0)
    if centred.dtype != object and most * most * centred.shape[1] < 2**63:
        return pa.array((centred * centred).sum(axis=1)).cast(pa.decimal128(38, 0))
    wide = centred.astype(object)
    return pa.array([int(v) for v in (wide * wide).sum(axis=1)], pa.decimal128(38, 0))


def _folded(parts: DataFrame, join: Callable[[list[bytes]], bytes]) -> bytes | None:
    """Join partial results (part, state) to one, ``FOLDED`` in a task, round after round.

    A state has a fixed size whatever the number of rows, so the last one may come to the driver.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        return pa.table({"part": table.column("part")[:1], "state": pa.array([join(table.column("state").to_pylist())], pa.binary())})

    parts = written(parts, "parts")
    while parts.count() > 1:
        numbered = parts.select(F.floor(F.col("part") / FOLDED).alias("part"), "state")
        parts = written(numbered.groupBy("part").applyInArrow(run, "part long, state binary"), "parts")
    last = parts.first()
    return None if last is None else bytes(last.state)


def _dense(state: bytes, width: int) -> np.ndarray:
    return np.frombuffer(state, dtype=float).reshape(-1, width)


def _spread(state: bytes, k: int) -> tuple[float, np.ndarray, np.ndarray]:
    values = np.frombuffer(state, dtype=float)
    return values[0], values[1 : k + 1], values[k + 1 :].reshape(k, k)


def _joined_spread(states: list[bytes], k: int) -> bytes:
    """Counts, means and centred products of several parts as those of all of them."""
    n, mean, products = _spread(states[0], k)
    for state in states[1:]:
        m, other, more = _spread(state, k)
        step = other - mean
        products = products + more + np.outer(step, step) * (n * m / (n + m))
        mean, n = mean + step * (m / (n + m)), n + m
    return np.concatenate([[n], mean, products.ravel()]).tobytes()


def fit_sums(vectors: DataFrame, column: str) -> tuple[int, int, list[int], bool]:
    """Rows that count, their length, exact sums per dimension, and whether 64 bits hold n * x - S."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, list] = {}
        for batch in batches:
            for d, (_, x) in _valid(batch, column).items():
                n, high, low, most = state.get(d, (0, 0, 0, 0))
                state[d] = [n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0), max(most, int(np.abs(x).max()))]
        for d, (n, high, low, most) in state.items():
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((d, n, most, high, low), types)], names)

    names, types = ["width", "n", "most", "high", "low"], [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
    parts = written(vectors.select(column).mapInArrow(run, "width long, n long, most long, high array<long>, low array<long>"), "sums")
    sizes = parts.groupBy("width").agg(F.sum("n").alias("n"), F.max("most").alias("most"))
    main = sizes.orderBy(F.desc("n"), F.desc("width")).first()
    if main is None:
        return 0, 0, [], True
    each = parts.where(F.col("width") == main.width).select(F.posexplode(F.arrays_zip("high", "low")).alias("i", "s"))
    sums = each.groupBy("i").agg(F.sum("s.high").alias("high"), F.sum("s.low").alias("low")).collect()  # a row per dimension
    total = [0] * main.width
    for r in sums:
        total[r.i] = (r.high << 32) + r.low
    return main.n, main.width, total, 2 * main.n * main.most < 2**62


def whiten(vectors: DataFrame, *, components: int = COMPONENTS, vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    An entry c counts as floor(64 c) + 1,000,000. Rows whose vector is null, or holds an entry
    that is null, not finite or beyond 64 bits, are left out of everything; so are empty
    vectors and those of another length than most have (of equally many, the longer).
    Repeated rows and null ids count like any other. Other columns are ignored.

    Sums are exact integers, so each row is centred without rounding twice. Tasks reduce
    their centred rows to one triangle R, block after block; triangles are joined some at a
    time; the last one, of the size of a vector squared, gives the directions of V. Directions
    along which the vectors don't vary are no components, so vectors that are all alike, one
    vector alone and an empty table give no rows. ``identity_error`` is measured on the rows
    that are returned.
    """
    spark = prepared(vectors.sparkSession)
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = f"{vec_id} {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    n, width, sums, small = fit_sums(vectors, column)
    if n == 0:
        return spark.createDataFrame([], schema)

    def rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, n * x - S, and x - S / n of the rows that count."""
        rows, x = _valid(batch, column).get(width, (np.zeros(0, np.int64), np.zeros((0, width), np.int64)))
        exact = _centred(x, n, sums, small)
        return rows, exact, (exact / n).astype(float)

    def triangle(blocks: list[np.ndarray]) -> np.ndarray:
        stacked = np.vstack(blocks)
        return np.linalg.qr(stacked, mode="r") if len(stacked) > 1 else stacked

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            _, _, centred = rows_of(batch)
            for at in range(0, len(centred), BLOCK_ROWS):
                r = triangle([r, centred[at : at + BLOCK_ROWS]])
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["part", "state"])

    state = _folded(
        vectors.select(column).mapInArrow(reduce_rows, "part long, state binary"),
        lambda states: triangle([_dense(s, width) for s in states]).tobytes(),
    )
    square = np.zeros((width, width))
    r = _dense(state, width)
    square[: len(r)] = r
    squares, directions = right_singular(square, min(components, width))
    k = len(squares)
    if not k:
        return spark.createDataFrame([], schema)
    explained = squares / float((square**2).sum())
    weights = (directions / np.sqrt(squares / n)[:, None]).T.copy()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, exact, centred = rows_of(batch)
            if len(rows):
                flat = (centred @ weights).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(vec_id).take(pa.array(rows)), _deviations(exact), lists], [vec_id, "deviation", "values"])

    wide = vectors.select(vec_id, column).mapInArrow(project, f"{vec_id} {kind}, deviation decimal(38,0), values array<double>")
    wide = written(wide, "whitened")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            if len(values):
                mean = values.mean(axis=0)
                own = np.concatenate([[len(values)], mean, ((values - mean).T @ (values - mean)).ravel()]).tobytes()
                state = own if state is None else _joined_spread([state, own], k)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([state], pa.binary())], ["part", "state"])

    state = _folded(wide.select("values").mapInArrow(spread, "part long, state binary"), lambda states: _joined_spread(states, k))
    count, _, products = _spread(state, k)
    error = float(np.abs(products / count - np.eye(k)).max())
    shares = F.array(*[F.lit(float(x)) for x in explained])
    each = wide.select(vec_id, "deviation", F.posexplode("values").alias("_at", "whitened"))
    return each.select(
        vec_id,
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("_at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
