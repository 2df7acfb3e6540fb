"""Readers and the writer, over files that Spark writes from the given tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks.registry import Inputs, query
from checks.flows import PAIR_TEXTS
from checks.scoring import PICKS, scored
from patchloom.functions import chat as C
from patchloom.operators import chats as H
from patchloom.operators.tasks import task_instances
from patchloom.operators.scoring import with_patch
from patchloom.plans import flows
from patchloom.sources import files, sinks


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder; a temporary one only on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("SELECT conv_id % 2 AS half, text FROM v_chat")
def sft_files(t: Inputs):
    """Two runs written, all runs read back and rendered."""
    folder = fresh_folder(t.spark, "sft")
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    chats = H.collect_turns(t.conversations, message, "messages")
    for half in (0, 1):
        rows = chats.where(F.col("conv_id") % 2 == half).select("messages")
        sinks.write_sft(rows, folder, "xml", f"run{half}")
    back = files.read_chat_jsonl(t.spark, folder)
    half = F.regexp_extract("file", r"ft_xml_run(\d)\.jsonl", 1).cast("bigint")
    return back.select(half.alias("half"), C.render_messages(F.col("messages")).alias("text"))


@query(
    "SELECT k.instance_id, k.repo, k.patch, coalesce(k.hints_text, '-') AS hints_text, array_to_string(f2p, '|') AS f2p "
    "FROM fx_tasks k JOIN v_valid v ON k.task_id = v.task_id"
)
def task_files(t: Inputs):
    folder = fresh_folder(t.spark, "tasks")
    tasks = task_instances(t.fx_tasks, t.fx_test_results)
    tasks.drop("task_id", "func_id", "strategy").write.json(folder)
    return files.read_tasks(t.spark, folder, lines_only=True).select(
        "instance_id",
        "repo",
        "patch",
        F.coalesce("hints_text", F.lit("-")).alias("hints_text"),
        F.array_join("FAIL_TO_PASS", "|").alias("f2p"),
    )


@query(
    """
, p AS (SELECT unnest(list_transform(string_split(body, concat(chr(10), chr(10))), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))) AS text FROM fx_corpus)
SELECT text, count(*) AS n FROM p WHERE text <> '' GROUP BY text"""
)
def corpus_files(t: Inputs):
    folder = fresh_folder(t.spark, "corpus")
    t.fx_corpus.select("body").write.text(folder)
    texts = files.read_corpus(t.spark, folder)
    return texts.groupBy("text").agg(F.count("*").alias("n"))


@query(
    "SELECT k.instance_id, k.patch, array_to_string(f2p, '|') AS f2p "
    "FROM fx_tasks k JOIN v_valid v ON k.task_id = v.task_id"
)
def validated_task_runs(t: Inputs):
    """Two runs of validated tasks, one of them written twice, read back as one set."""
    folder = fresh_folder(t.spark, "validated")
    tasks = task_instances(t.fx_tasks, t.fx_test_results).drop("task_id", "func_id", "strategy")
    even = F.pmod(F.crc32("instance_id"), F.lit(2)) == 0
    for key, rows in (("a", tasks.where(even)), ("b", tasks.where(~even)), ("a", tasks.where(even))):
        sinks.write_tasks(rows, folder, key)
    back = files.read_tasks(t.spark, folder)
    return back.select("instance_id", "patch", F.array_join("FAIL_TO_PASS", "|").alias("f2p"))


@query("SELECT concat(task_id, '-', gen) AS instance_id, coalesce(patch, '-') AS model_patch FROM v_patch")
def prediction_runs(t: Inputs):
    folder = fresh_folder(t.spark, "predictions")
    name = F.concat(F.col("task_id").cast("string"), F.lit("-"), F.col("gen").cast("string"))
    patches = with_patch(t.fx_completions).select(name.alias("instance_id"), F.col("patch").alias("model_patch"))
    sinks.write_predictions(patches, folder)
    back = files.read_predictions(t.spark, folder)
    return back.select("instance_id", F.coalesce("model_patch", F.lit("-")).alias("model_patch"))


@query(
    PICKS
    + """, low AS (SELECT task_id, gen AS rejected_gen, reward AS rejected_reward FROM v_hybrid
  QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY reward, gen) = 1),
pairs AS (SELECT task_id, chosen_gen, rejected_gen FROM top JOIN low USING (task_id) WHERE chosen_reward > rejected_reward)
SELECT prompt, chosen, rejected FROM ("""
    + PAIR_TEXTS
    + ")"
)
def preference_runs(t: Inputs):
    folder = fresh_folder(t.spark, "preferences")
    sinks.write_preferences(flows.preference_set(t.fx_tasks, t.fx_completions, scored(t)), folder)
    return files.read_preferences(t.spark, folder)
