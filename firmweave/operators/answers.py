"""Answers of a foreign function (a model behind a network, say) to prompts: asked once, kept as they come.

Answers are content-addressed: a prompt's key is the SHA-256 of label and prompt. Tasks ask in small groups, several at once, and write each
group's answers to the store before they go on. A task that is tried again, and any later run over the same store, reads what is
there and asks only for the rest. If the function raises, that prompt is asked again up to ``retries`` times; what has been answered is saved
whatever ends the task. Only when a worker is killed are the calls of one group lost.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.session import ensure_checkpoint_dir

_KEPT = "key string, answer string"
# Prompts a task asks for before it writes their answers.
GROUP = 16


def _system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


def _answered(folder: str) -> set[str]:
    """Keys that earlier attempts of a task have answers to."""
    from pyarrow import fs

    system, inner = _system(folder)
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    keys: set[str] = set()
    for f in found:
        if f.path.endswith(".jsonl"):
            with system.open_input_stream(f.path) as stream:
                keys.update(json.loads(line)["key"] for line in stream.read().splitlines())
    return keys


def _keep(folder: str, answers: list[tuple[str, str]]) -> None:
    """Write answers as one file, there as a whole or not at all."""
    system, inner = _system(folder)
    system.create_dir(inner, recursive=True)
    name = uuid.uuid4().hex
    with system.open_output_stream(f"{inner}/.{name}") as out:
        out.write("".join(json.dumps({"key": k, "answer": a}) + "\n" for k, a in answers).encode())
    system.move(f"{inner}/.{name}", f"{inner}/{name}.jsonl")


class _Pace:
    """At most so many calls a second, over all threads of a task."""

    def __init__(self, per_second: float | None):
        self.gap, self.next = (1 / per_second if per_second else 0.0), 0.0

    def wait(self) -> None:
        now = time.monotonic()
        at = max(now, self.next)
        self.next = at + self.gap
        if at > now:
            time.sleep(at - now)


def kept_answers(spark: SparkSession, store: str) -> DataFrame:
    """``key`` and ``answer`` of all prompts the store knows; one row a key."""
    files = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
        return spark.createDataFrame([], _KEPT)
    rows = spark.read.schema(_KEPT).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").json(store)
    # Two attempts of one task may have asked at the same time.
    return rows.groupBy("key").agg(F.min("answer").alias("answer"))


def with_answers(
    df: DataFrame,
    scorer: Callable[[str], str | None],
    store: str | None = None,
    retries: int = 2,
    tasks: int | None = None,
    threads: int = 4,
    per_second: float | None = None,
    label: str = "",
) -> DataFrame:
    """``df`` (with ``prompt``) and ``answer``: what ``scorer`` says, asked once for each different prompt.

    ``store``: a shared folder; answers there are used, new ones added. Without it one in the checkpoint folder serves this call. ``label`` tells
    apart answers of different scorers in one store. At most ``tasks`` times ``threads`` calls run at once, ``per_second`` in all. Null prompts are
    not asked. A prompt whose calls all fail, or whose answer is null, gets NULL and is asked again by a later run.
    """
    spark = df.sparkSession
    store = store or f"{ensure_checkpoint_dir(spark)}/answers/{uuid.uuid4().hex}"
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = f"{store}/{uuid.uuid4().hex}"
    pace_of_task = per_second / tasks if per_second else None
    key = F.sha2(F.concat(F.lit(f"{len(label)}:{label}"), F.col("prompt")), 256)
    keyed = df.withColumn("_key", key)
    different = keyed.where(F.col("prompt").isNotNull()).groupBy(F.col("_key").alias("key")).agg(F.first("prompt").alias("prompt"))
    open_ = different.join(kept_answers(spark, store).select("key"), "key", "left_anti").repartition(tasks, "key")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        folder = f"{run}/{TaskContext.get().partitionId()}"
        known, pace = _answered(folder), _Pace(pace_of_task)

        def call(prompt: str) -> str | None:
            for _ in range(retries + 1):
                pace.wait()
                try:
                    return scorer(prompt)
                except Exception:  # the scorer is foreign code; a failed call is no answer
                    continue
            return None

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                rows = [r for r in zip(batch["key"], batch["prompt"], strict=True) if r[0] not in known]
                for at in range(0, len(rows), GROUP):
                    calls = [(k, pool.submit(call, p)) for k, p in rows[at : at + GROUP]]
                    ended: BaseException | None = None
                    said = []
                    for k, c in calls:
                        ended = c.exception() or ended
                        if c.exception() is None and c.result() is not None:
                            said.append((k, c.result()))
                    if said:
                        _keep(folder, said)
                    if ended is not None:
                        raise RuntimeError(f"the scorer ended the task: {ended!r}")
                yield pd.DataFrame({"n": [len(rows)]})

    open_.mapInPandas(ask, "n long").agg(F.sum("n")).collect()  # one row; the answers are in the store
    answers = kept_answers(spark, store)
    return keyed.join(answers, keyed["_key"] == answers["key"], "left").drop("_key", "key")
