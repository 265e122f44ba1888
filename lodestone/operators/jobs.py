"""The grid of requests: problems x attempts of a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import SPARK
from . import prompts
from .registry import served_window


def attempts_grid(df: DataFrame, n: int, column: str = "i") -> DataFrame:
    """Each row once for each attempt 0..n-1; no rows for n = 0."""
    if n < 1:
        return df.withColumn(column, F.lit(0)).where(F.lit(False))
    return df.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def seed(base: str = "seed", i: str = "i") -> str:
    """base + i as an unsigned 32-bit number."""
    return f"({base} + {i}) % 4294967296"


def plan_jobs(theorems: DataFrame, model: DataFrame, n: int) -> DataFrame:
    """name, i, attempt_key, prompt, seed, served_window and request (JSON) of each attempt.

    model: rows of the registry (one for each model to plan). The prompt is
    rendered once for each problem, below the generator of attempts.
    """
    rows = theorems.join(F.broadcast(model.withColumnRenamed("name", "model")), how="cross")  # the registry is a fixed handful of rows
    user = rows.withColumn("user", F.expr(prompts.prompt_for(SPARK, "prompt_format")))
    chat = prompts.chat_for(SPARK, "architecture", "user", "system_prompt", "prompt_format")
    jobs = attempts_grid(user.withColumn("prompt", F.expr(chat)), n)
    jobs = jobs.withColumn("job_seed", F.expr(seed("seed", "i"))).withColumn("served_window", F.expr(served_window()))
    request = F.to_json(F.struct("prompt", "max_tokens", "temperature", "top_p", F.col("job_seed").alias("seed"), F.col("stop_sequences").alias("stop")))
    return jobs.select("model", "name", "i", F.concat(F.lit("attempt_"), (F.col("i") + 1).cast("string")).alias("attempt_key"), "prompt", F.col("job_seed").alias("seed"), "served_window", request.alias("request"))


def micro_batches(df: DataFrame, size: int, column: str = "i") -> DataFrame:
    """batch_start and batch_seed (1 + start) of each attempt in batches of size."""
    return df.withColumn("batch_start", F.col(column) - F.col(column) % size).withColumn("batch_seed", F.col("batch_start") + 1)
