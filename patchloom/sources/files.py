"""Reading task, patch, chat, corpus, report and metric files as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.functions.text import strip
from patchloom.operators.scans import running
from patchloom.sources.sinks import PREDICTIONS, PREFERENCES, plain_and_runs, run_folders, size_below

# What one task numbers and groups at most: lines of a text file, bytes of prediction files.
BLOCK_LINES = 1 << 12
GROUP_BYTES = 32 * 1024 * 1024

TASK_SCHEMA = (
    "instance_id string, repo string, patch string, problem_statement string, hints_text string, "
    "FAIL_TO_PASS array<string>, PASS_TO_PASS array<string>, task_file string"
)
CHAT_SCHEMAS = {
    "messages": "messages array<struct<role:string,content:string>>",
    "sharegpt": "conversations array<struct<`from`:string,value:string>>",
    "alpaca": "instruction string, input string, output string",
}
PREFERENCE_SCHEMA = "prompt string, chosen string, rejected string"
PREDICTION_SCHEMA = "instance_id string, model_patch string"
ITERATION_SCHEMA = (
    "iteration bigint, candidate string, split string, score double, cost double, ts timestamp"
)
TRIAL_SCHEMA = "trial bigint, eval_loss double, params map<string,string>, state string"


def _is_directory(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def _json_lines(spark: SparkSession, path: str | list[str], schema: str, glob: str, **options: str) -> DataFrame:
    """Splittable JSON lines; blank lines are skipped and a bad line fails the read."""
    return spark.read.options(mode="FAILFAST", pathGlobFilter=glob, **options).schema(schema).json(path)


def _json_documents(spark: SparkSession, path: str, schema: str, glob: str = "*", **options: str) -> DataFrame:
    """Rows of JSON files that are one list of rows, or one object whose values are the rows.

    A single JSON value has no line to be split at, but it has braces: files are read in splits
    as records that end with one. Whether a record begins inside a string is the parity of the
    quotes before it, and how deep it lies is a sum of braces outside strings, so sums over
    splits tell where each row ends, and only its own records are put together. A file of any
    size is read by as many tasks as it has splits. A row that cannot be parsed, and what is
    left over of a file that does not end as it should, fail the read.
    """
    text = spark.read.options(pathGlobFilter=glob, lineSep="}", **options).text(path)
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.regexp_count(plain, F.lit('"')).cast("bigint")

    def structure(inside: int) -> Column:
        """Braces opened less closed, and whether the record's own brace closes, from either state."""
        ends_inside = (quotes + inside) % 2
        closed = F.concat(F.lit('"' * inside), plain, F.when(ends_inside == 1, '"').otherwise(""))
        opened = F.regexp_count(F.regexp_replace(closed, '"[^"]*"', ""), F.lit(r"\{"))
        return F.struct((opened - 1 + ends_inside).cast("bigint").alias("depth"), (ends_inside == 0).alias("closes"))

    records = text.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("line"),  # rises within a split
        quotes.alias("quotes"),
        structure(0).alias("outside"),
        structure(1).alias("inside"),
    )

    def scan(rows: DataFrame, values: dict, inclusive: bool) -> DataFrame:
        # what comes before a split is one row per split, which is broadcast
        return running(rows, ["file_path"], ["start", "line"], "start", values, inclusive=inclusive, dealt=True)

    one = F.lit(1).cast("bigint")
    begun = scan(records, {"before": ("sum", F.col("quotes")), "nth": ("sum", one)}, inclusive=False)
    state = F.when(F.col("before") % 2 == 1, F.col("inside")).otherwise(F.col("outside"))
    # the values of one object lie one brace deeper than the entries of a list
    base = F.when(F.col("nth") == 0, F.when(F.regexp_like("value", F.lit(r"^\s*\{")), 1).otherwise(0))
    known = begun.select("value", "file_path", "file_size", "start", "line", state.alias("s"), base.cast("bigint").alias("own"))
    length = (F.octet_length("value") + 1).cast("bigint")
    deep = scan(known, {"depth": ("sum", F.col("s.depth")), "base": ("max", F.col("own")), "read": ("sum", length)}, inclusive=True)
    broken = F.raise_error(F.concat(F.lit("not a JSON list or object of rows: "), F.col("file_path"))).cast("boolean")
    closes = F.col("s.closes") & (F.col("depth") == F.col("base"))
    whole = F.when(closes & (F.col("read") >= F.col("file_size")), broken).otherwise(closes)  # a file can't end with a row
    ended = deep.select("value", "file_path", "start", "line", "base", whole.alias("whole"))
    placed = scan(ended, {"row": ("sum", F.when(F.col("whole"), one).otherwise(0))}, inclusive=False)
    rows = placed.groupBy("file_path", "row").agg(
        F.sort_array(F.collect_list(F.struct("start", "line", "value"))).alias("parts"), F.max("base").alias("base"), F.bool_or("whole").alias("whole")
    )
    joined = F.concat(F.array_join("parts.value", "}"), F.lit("}"))
    rest = F.regexp_replace(joined, r"\s", "")
    # at its end a list has no brace, but its last record was given one
    proper = F.when(F.col("base") == 0, rest.isin("]}", "[]}", "}")).otherwise(rest.isin("}", "}}", "{}", "{}}"))
    wanted = rows.where(F.when(F.col("whole"), True).when(proper, False).otherwise(broken))
    # before a row stand a bracket or comma, and the row's key in an object
    entry, value = r"^\s*[\[,]\s*", r'^\s*[{,]\s*"(?:[^"\\]|\\.)*"\s*:\s*'
    body = F.when(F.col("base") == 0, F.regexp_replace(joined, entry, "")).otherwise(F.regexp_replace(joined, value, ""))
    parsed = wanted.select("file_path", F.from_json(body, f"struct<{_struct(schema)}>", {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("file_path", "r.*")


def _struct(schema: str) -> str:
    return ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema))


def read_chat_jsonl(spark: SparkSession, path: str, layout: str = "messages") -> DataFrame:
    """All ``ft_*.jsonl`` files, directories of that name and runs, with the file each row came from."""
    paths = plain_and_runs(spark, path, "ft_*.jsonl")
    rows = spark.read.option("mode", "FAILFAST").schema(CHAT_SCHEMAS[layout]).json(paths)
    return rows.select("*", F.col("_metadata.file_path").alias("file"))


def read_tasks(spark: SparkSession, path: str, *, lines_only: bool = False) -> DataFrame:
    """Task instances from JSON lines, JSON lists and JSON objects keyed by id.

    ``path`` is a file or a directory; ``*.jsonl`` holds lines and ``*.json`` one list or
    object; runs that ``write_tasks`` made in the directory are read as well. With
    ``lines_only`` every file is read as lines, whatever its name, as for the output of a
    Spark job.
    """
    if lines_only:
        return _json_lines(spark, path, TASK_SCHEMA, "*")
    lines = _json_lines(spark, path, TASK_SCHEMA, "*.jsonl")
    if runs := run_folders(spark, path, "validated_*.jsonl"):
        lines = lines.unionByName(_json_lines(spark, runs, TASK_SCHEMA, "*"))
    documents = _json_documents(spark, path, TASK_SCHEMA, "*.json").drop("file_path")
    return lines.unionByName(documents)


def _paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank paragraphs of text files: runs of text between empty lines.

    Files of every size are read line by line in splits; lines are numbered by the empty
    lines before them, ``BLOCK_LINES`` of a split at a time, and gathered per paragraph, so no
    task ever holds a file or a split. A byte order mark is no text.
    """
    lines = spark.read.option("pathGlobFilter", "*.txt").text(path)
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),  # rises within a split
    )
    empty = F.when(F.col("value") == "", 1).otherwise(0).cast("bigint")
    block = F.struct("start", F.floor(F.col("line") / BLOCK_LINES).alias("part"))
    numbered = running(placed, ["file"], ["start", "line"], block, {"number": ("sum", empty)})
    gathered = (
        numbered.where("value <> ''")
        .groupBy("file", "number")
        .agg(F.sort_array(F.collect_list(F.struct("start", "line", "value"))).alias("lines"))
    )
    whole = F.array_join("lines.value", "\n")
    return gathered.select(strip(whole).alias("text")).where("text <> ''")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Texts for continued pretraining: one ``.txt`` file, or a directory.

    Text files give their non-blank paragraphs; JSON lines give ``text``, where a missing
    text is empty and kept.
    """
    if not _is_directory(spark, path):
        if not path.endswith(".txt"):
            raise ValueError(f"not a corpus: {path}")
        return _paragraphs(spark, path)
    lines = _json_lines(spark, path, "text string", "*.jsonl")
    texts = _paragraphs(spark, path)
    return texts.unionByName(lines.select(F.coalesce("text", F.lit("")).alias("text")))


def read_preferences(spark: SparkSession, path: str, schema: str = PREFERENCE_SCHEMA) -> DataFrame:
    """Chosen and rejected pairs: the run of a directory, else its ``dpo_preferences.json``; or a file."""
    if runs := run_folders(spark, path, PREFERENCES):
        return _json_lines(spark, runs, schema, "*")
    file = f"{path}/dpo_preferences.json" if _is_directory(spark, path) else path
    return _json_documents(spark, file, schema).drop("file_path")


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """``*/report.json``, one directory level: the directory's name and its verdict.

    A report that cannot be parsed fails the read.
    """
    rows = spark.read.options(multiLine="true", mode="FAILFAST").schema("resolved boolean").json(f"{path}/*/report.json")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/report\.json$", 1)
    return rows.select(
        F.url_decode(name).alias("instance_id"), F.coalesce("resolved", F.lit(False)).alias("resolved")
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Every ``preds.json`` and ``all_preds.jsonl`` below a directory, one row per instance.

    A run that ``write_predictions`` made in the directory itself counts as well. Where files
    disagree the first in path order wins. Rows are grouped in as many tasks as the files have
    ``GROUP_BYTES``: the least of texts is found by sorting, and rows that repeat a path pack
    so well that the size of a shuffle says little about the memory of that.
    """
    deep = {"recursiveFileLookup": "true"}
    lines = _json_lines(spark, path, PREDICTION_SCHEMA, PREDICTIONS, **deep)
    lines = lines.select("*", "_metadata.file_path")
    if runs := run_folders(spark, path, PREDICTIONS):
        lines = lines.unionByName(_json_lines(spark, runs, PREDICTION_SCHEMA, "*").select("*", "_metadata.file_path"))
    documents = _json_documents(spark, path, PREDICTION_SCHEMA, "preds.json", **deep)
    first = F.min(F.struct("file_path", "model_patch"))
    both = lines.unionByName(documents)
    tasks = -(-size_below(spark, path) // GROUP_BYTES)
    if tasks > 1:
        both = both.repartition(tasks, "instance_id")
    return both.groupBy("instance_id").agg(first.alias("_f")).select("instance_id", "_f.model_patch")


def collect_patches(spark: SparkSession, path: str) -> DataFrame:
    """Every ``.diff`` file below a directory, whole, with its path."""
    files = spark.read.options(recursiveFileLookup="true", pathGlobFilter="*.diff").text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("patch"))


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Saved tuning trials: a JSON list of trial, eval_loss, params and state."""
    return spark.read.options(multiLine="true", mode="FAILFAST").schema(TRIAL_SCHEMA).json(path)


def read_iterations(
    spark: SparkSession, path: str, schema: str = ITERATION_SCHEMA, *, stream: bool = False
) -> DataFrame:
    """Every ``iterations.jsonl`` below a directory, as a table or as a stream of new files.

    A line that cannot be parsed fails the read.
    """
    reader = spark.readStream if stream else spark.read
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "iterations.jsonl", "mode": "FAILFAST"}
    return reader.options(**options).schema(schema).json(path)
