"""Writing training sets, task sets, predictions and preference pairs as runs.

A run's rows go to a new folder that nothing reads yet; the run then becomes visible by one
small manifest, put in place by an atomic rename. So a job that dies at any moment leaves the
former run, and a job or a stream's batch that is repeated replaces its own manifest and adds
nothing. Readers take plain files and the runs that manifests name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Below a directory: rows in folders of their own, and the manifests that name them.
DATA, RUNS = "data", "runs"
PREFERENCES, PREDICTIONS = "dpo_preferences.jsonl", "all_preds.jsonl"


def _path(spark: SparkSession, *parts: str):
    target = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _matching(spark: SparkSession, pattern: str) -> list:
    fs, target = _path(spark, pattern)
    return [s.getPath() for s in fs.globStatus(target) or []]


def size_below(spark: SparkSession, pattern: str) -> int:
    """Bytes of all files at and below a path, those of replaced runs included."""
    conf = spark._jsc.hadoopConfiguration()
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in _matching(spark, pattern))


def _read(spark: SparkSession, target) -> str:
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _commit(spark: SparkSession, directory: str, name: str, part: str, data: str) -> None:
    """Name the folder ``data`` (relative to the directory) as a part of a run."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, final = _path(spark, directory, RUNS, name, part)
    _, draft = _path(spark, directory, RUNS, name, f".{part}-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(data.encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    files.rename(fs.makeQualified(draft), fs.makeQualified(final), how)


def write_run(df: DataFrame, directory: str, name: str, *, part: str = "all", format: str = "json") -> str:
    """Write rows as a run (or one part of a run) of a directory; returns the folder of the rows.

    Writing a run, or a part, again replaces it and nothing else. Rows of a job that died, and
    of a run that was replaced, stay in their folders until ``sweep``.
    """
    if format not in ("json", "parquet"):
        raise ValueError(f"unknown format {format!r}")
    data = f"{DATA}/{uuid.uuid4().hex}/{name}"
    df.write.format(format).save(f"{directory}/{data}")
    _commit(df.sparkSession, directory, name, part, data)
    return f"{directory}/{data}"


def run_folders(spark: SparkSession, directory: str, pattern: str) -> list[str]:
    """The folders of all runs whose name matches: one per manifest."""
    manifests = _matching(spark, f"{directory}/{RUNS}/{pattern}/[!.]*")
    return [f"{directory}/{_read(spark, m)}" for m in manifests]


def plain_and_runs(spark: SparkSession, directory: str, pattern: str) -> list[str]:
    """What to read for a pattern of names: plain files or folders, and committed runs."""
    plain = f"{directory}/{pattern}"
    runs = run_folders(spark, directory, pattern)
    return [plain, *runs] if _matching(spark, plain) or not runs else runs


def sweep(spark: SparkSession, directory: str) -> int:
    """Delete folders of rows that no manifest names; returns how many.

    For a time when no job writes to the directory.
    """
    named = {f.rsplit("/", 2)[1] for f in run_folders(spark, directory, "*")}
    fs, _ = _path(spark, directory)
    unnamed = [p for p in _matching(spark, f"{directory}/{DATA}/*") if p.getName() not in named]
    for target in unnamed:
        fs.delete(target, True)
    return len(unnamed)


def batch_writer(directory: str, name: str) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch``: each batch is a part of the run, repeated or not."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_run(df, directory, name, part=f"batch-{batch_id:020d}")

    return write


def sft_name(style: str, run_id: str, format: str = "json") -> str:
    return f"ft_{style}_{run_id}.{'parquet' if format == 'parquet' else 'jsonl'}"


def write_sft(df: DataFrame, directory: str, style: str, run_id: str, format: str = "json") -> str:
    """Write examples as the run ``ft_<style>_<run_id>.jsonl``; ``read_chat_jsonl`` reads all of them."""
    return write_run(df, directory, sft_name(style, run_id, format), format=format)


def write_tasks(tasks: DataFrame, directory: str, key: str) -> str:
    """Write validated tasks as the run ``validated_<key>.jsonl``, for ``read_tasks``."""
    return write_run(tasks, directory, f"validated_{key}.jsonl")


def write_predictions(predictions: DataFrame, directory: str) -> str:
    """Write instance_id and model_patch as the run ``all_preds.jsonl``, for ``read_predictions``."""
    return write_run(predictions.select("instance_id", "model_patch"), directory, PREDICTIONS)


def write_preferences(pairs: DataFrame, directory: str) -> str:
    """Write prompt, chosen and rejected as the run ``dpo_preferences.jsonl``, for ``read_preferences``."""
    return write_run(pairs.select("prompt", "chosen", "rejected"), directory, PREFERENCES)
