"""Runs of a completion backend: batch, and incremental from a folder of completions."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as t
from ..operators import extract, jobs, registry, results
from ..sources.problems import exists
from ..sources.stores import DoneSet

#: Tries of a request after the first, with waits of 1, 2 and 4 seconds.
RETRIES = 3
#: Folders that the keys of followed results are dealt to by theorem; a micro-batch reads those of its theorems.
KEY_PARTS = 64
COMPLETIONS = "model string, theorem string, attempt_key string, body string"


def complete(plan: DataFrame, backend: Callable[[str], str], parallel: int, wait: float = 1.0) -> DataFrame:
    """model, theorem, attempt_key and body of each job: at most `parallel` requests are under way at once.

    The backend gets a request (JSON) and returns a response body. If it raises,
    it is tried again; an exhausted request has an empty body.
    """

    def run(frames):
        for f in frames:
            bodies = []
            for request in f["request"]:
                body = ""
                for k in range(RETRIES + 1):
                    try:
                        body = backend(request)
                        break
                    except Exception:
                        if k < RETRIES:
                            time.sleep(wait * 2**k)
                bodies.append(body)
            yield pd.DataFrame({"model": f["model"], "theorem": f["name"], "attempt_key": f["attempt_key"], "body": bodies})

    return plan.select("model", "name", "attempt_key", "request").repartition(parallel).mapInPandas(run, COMPLETIONS)


def postprocess(completions: DataFrame, theorems: DataFrame, models: DataFrame, mode: str = "default") -> DataFrame:
    """model, theorem, attempt_key, raw (repaired text), strategy, proof and lean of each completion."""
    arch = F.broadcast(models.select(F.col("name").alias("model"), "architecture"))  # the registry is a fixed handful of rows
    rows = completions.join(arch, "model").withColumn("raw", t.column(t.completion_text, "body"))
    rows = rows.withColumn("raw", t.column(t.decode_for, "architecture", "raw"))
    return extract.re_extract(rows.select("model", "theorem", "attempt_key", "raw"), theorems, mode)


def generate(spark: SparkSession, theorems: DataFrame, model: str, backend: Callable[[str], str], out_dir: str, n: int = 128, parallel: int = 8, run_id: str = "default") -> DataFrame | None:
    """Complete what is pending for a model and store it, data before done-marks; None if nothing was pending."""
    done = DoneSet(spark, f"{out_dir}/checkpoints", model, run_id)
    todo = results.pending(theorems, done.names())
    if todo.isEmpty():
        return None
    plan = jobs.plan_jobs(todo, registry.find_model(spark, model), n)
    found = postprocess(complete(plan, backend, parallel), theorems, registry.models(spark))
    batch = f"{int(time.time() * 1000)}"
    path = f"{out_dir}/results/{batch}"
    found.write.parquet(path)
    stored = spark.read.parquet(path)
    done.mark(results.complete_groups(stored, n).select(F.col("theorem").alias("name")), batch)
    return stored


def follow(spark: SparkSession, completions_dir: str, theorems: DataFrame, model: str, out_dir: str, n: int, run_id: str = "default") -> StreamingQuery:
    """Process completions (JSON rows) as they arrive, once each.

    A micro-batch writes its results into a folder of its own and then marks the
    theorems that have n attempts by now; both replace themselves on a retry, so
    a crash between them loses nothing and a theorem is never done before its
    data is stored. Attempts of incomplete theorems stay stored and unmarked. The
    keys of pending theorems' attempts stand in a folder of their own, and a
    micro-batch reads the keys of the theorems it touches.
    """
    done = DoneSet(spark, f"{out_dir}/checkpoints", model, run_id)

    def batch(df: DataFrame, k: int) -> None:
        found = postprocess(df.where(F.col("model") == model), theorems, registry.models(spark))
        path = f"{out_dir}/results/batch={k}"
        found.write.mode("overwrite").parquet(path)
        keys = spark.read.parquet(path).select(F.pmod(F.xxhash64("theorem"), F.lit(KEY_PARTS)).alias("part"), "theorem", "attempt_key").distinct()
        keys.write.mode("overwrite").partitionBy("part").parquet(f"{out_dir}/keys/batch={k}")
        touched = spark.read.parquet(f"{out_dir}/keys/batch={k}").select("part", "theorem").distinct()
        parts = sorted(r["part"] for r in touched.select("part").distinct().collect())  # KEY_PARTS at most
        every = spark.read.option("basePath", f"{out_dir}/keys").schema("theorem string, attempt_key string, batch int, part int").parquet(f"{out_dir}/keys").where(F.col("part").isin(parts))
        stored = every.join(touched.select("theorem"), "theorem", "left_semi").select("theorem", "attempt_key").distinct()
        full = results.complete_groups(stored, n).select(F.col("theorem").alias("name")).distinct()
        done.mark(results.pending(full, done.names()), k)

    rows = spark.readStream.schema(COMPLETIONS).json(completions_dir)
    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", f"{out_dir}/stream").trigger(availableNow=True).start()


def stored_results(spark: SparkSession, out_dir: str) -> DataFrame:
    """All results of a followed folder; of an attempt that came twice, the later one."""
    path = f"{out_dir}/results"
    if not exists(spark, path):
        raise FileNotFoundError(path)
    rows = spark.read.parquet(path)
    newest = rows.groupBy("model", "theorem", "attempt_key").agg(F.max_by(F.struct("raw", "strategy", "proof", "lean"), "batch").alias("r"))
    return newest.select("model", "theorem", "attempt_key", "r.*")
