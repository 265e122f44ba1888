"""Files made of the driver's tables, for the queries over sources, sinks and runs."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import stores
from ..streaming import generate as run
from .fixtures import view

#: The model of the run.
MODEL = "kimina-prover-distill-8b"


def folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset and all runs in one process, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="lodestone-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        return f"file://{base}"
    path = f"{base.rstrip('/')}/files-{uuid.uuid4().hex}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def problem_files(spark: SparkSession, sf_dir: str, combined: bool) -> str:
    """A folder of problem records: a file of each split, or with combined one of all and that of the split test."""
    out, rows = folder(spark), view(spark, sf_dir, "theorems").drop("item_id")
    for split in ("test", "valid")[: 1 if combined else 2]:
        rows.where(F.col("split") == split).write.json(f"{out}/raw/{split}.jsonl")
    if combined:
        rows.write.json(f"{out}/raw/all.jsonl")
    return out


def stored(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """What read_document finds after write_documents stored raw and lean texts twice (the first ones are backed up)."""
    out = folder(spark)
    key = F.concat_ws(" ", "theorem", "attempt_key")
    found = view(spark, sf_dir, "attempts").select("theorem", "attempt_key", key.alias("raw"), F.md5(key).alias("lean"))
    stores.write_documents(found.withColumns({"raw": F.lit("old"), "lean": F.lit("old")}), out, MODEL)
    stores.write_documents(found, out, MODEL)
    return stores.read_document(spark, f"{out}/{'raw_output' if kind == 'raw' else 'lean_code'}/{stores.stem(MODEL)}", MODEL, missing="error")


def done_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = stores.DoneSet(spark, folder(spark), MODEL)
    rows = view(spark, sf_dir, "theorems")
    for batch, keep in enumerate(("item_id % 5 < 2", "item_id % 5 in (1, 2)", "item_id % 5 = 3")):
        done.mark(rows.where(keep).unionByName(rows.where(keep)), batch)
    done.mark(rows.where("item_id % 5 = 3"), 2)
    return done.names()


def generated(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """What a run stores; a second run finds nothing pending and stores nothing more."""

    def answer(request: str) -> str:
        """A response by the request's seed: text, an error body, a text that is no string."""
        kind = json.loads(request)["seed"] % 3
        return json.dumps([{"choices": [{"text": "```lean4\n  rfl\n```"}]}, {"error": "x"}, {"choices": [{"text": 5}]}][kind])

    out, rows = folder(spark), view(spark, sf_dir, "theorems")
    found = run.generate(spark, rows, MODEL, answer, out, n)
    if run.generate(spark, rows, MODEL, answer, out, n) is not None:
        raise AssertionError("the second run found theorems that the first one had done")
    return found.select("model", "theorem", "attempt_key", "raw", "proof", "lean")
