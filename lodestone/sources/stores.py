"""Results and done-sets in files.

The default store is rows (Parquet, one folder for each batch), which scales and
is written by Spark's committer. Nested JSON documents and JSON done-sets are
read and written for exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract, results
from .problems import exists


def stem(model: str) -> str:
    """A model's name as part of a path."""
    return model.replace("/", "_").replace(" ", "_")


def read_document(spark: SparkSession, path: str, model: str, leaves: str = "drop", missing: str = "empty") -> DataFrame:
    """theorem, attempt_key and value of a nested document.

    A missing file gives no rows; a missing model gives none either, or fails
    for missing="error" (as re-extraction asks).
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "theorem string, attempt_key string, value string")
    docs = spark.read.text(path, wholetext=True).withColumnRenamed("value", "document")
    if missing == "error" and docs.where(F.try_variant_get(F.parse_json("document"), f"$['{model}']", "variant").isNotNull()).isEmpty():
        raise KeyError(f"{path} has no results of {model}")
    return results.unnest(docs, model, leaves=leaves)


def keep_backup(spark: SparkSession, path: str) -> None:
    """Move what a path holds aside, to <path>.bak, in place of an older backup."""
    if not exists(spark, path):
        return
    old, bak = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.bak"))
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(bak, True)
    if not fs.rename(old, bak):
        raise OSError(f"{path} could not be backed up")


def write_documents(found: DataFrame, out_dir: str, model: str) -> dict[str, float]:
    """Write the raw and the assembled texts as one document each (2 GB at most, made in one task); their sizes in MB to one decimal.

    An earlier document of assembled texts stays as a backup.
    """
    sizes = {}
    for kind, folder in (("raw", "raw_output"), ("lean", "lean_code")):
        path = f"{out_dir}/{folder}/{stem(model)}"
        if kind == "lean":
            keep_backup(found.sparkSession, path)
        results.document(found, model, kind).coalesce(1).write.mode("overwrite").text(path)
        stored = found.sparkSession.read.text(path, wholetext=True)
        sizes[kind] = stored.select(F.round((F.octet_length("value") - 1) / 1e6, 1)).first()[0]  # without the line's end
    return sizes


def write_rows(found: DataFrame, out_dir: str, model: str, batch: str | int = 0) -> dict[str, float]:
    """Write keys, raw and assembled texts as rows, by as many tasks as there are parts; their sizes in MB to one decimal.

    The same batch again replaces itself. This is the sink for results of any size.
    """
    path = f"{out_dir}/results/{stem(model)}/batch={batch}"
    found.select(*results.KEYS, "raw", "lean").write.mode("overwrite").parquet(path)
    total = found.sparkSession.read.parquet(path).agg(*[F.round(F.coalesce(F.sum(F.octet_length(k)), F.lit(0)) / 1e6, 1).alias(k) for k in ("raw", "lean")]).first()
    return total.asDict()


def re_extract_file(spark: SparkSession, out_dir: str, model: str, theorems: DataFrame, mode: str = "default") -> DataFrame:
    """Extract again from a model's stored raw document and store the assembled texts; total, recovered and rate.

    Fails where the document is missing or lacks the model. Of several records of a name the last counts.
    """
    path = f"{out_dir}/raw_output/{stem(model)}"
    if not exists(spark, path):
        raise FileNotFoundError(path)
    raw = read_document(spark, path, model, leaves="empty", missing="error").withColumnRenamed("value", "raw")
    found = extract.re_extract(raw, theorems, mode)
    target = f"{out_dir}/lean_code/{stem(model)}"
    keep_backup(spark, target)
    results.document(found, model, "lean").coalesce(1).write.mode("overwrite").text(target)
    return extract.recovery(found)


def status(spark: SparkSession, folder: str, models: DataFrame, run_id: str = "default") -> DataFrame:
    """Of every model the size of its done-set in a run (0 where there is none). The registry is a fixed handful of models."""
    sets = [DoneSet(spark, folder, r["name"], run_id).names().withColumn("model", F.lit(r["name"])) for r in models.select("name").collect()]
    every = sets[0]
    for s in sets[1:]:
        every = every.unionByName(s)
    return results.done_counts(models, every.select("model", "name"))


def ready(spark: SparkSession, path: str) -> bool:
    """Whether a model's folder holds its settings and weights: config.json and a .safetensors file."""
    if not exists(spark, f"{path}/config.json"):
        return False
    weights = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/*.safetensors")
    return len(weights.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(weights) or []) > 0


class DoneSet:
    """Names that are done for a model and run: rows in a folder, one subfolder for each batch."""

    def __init__(self, spark: SparkSession, folder: str, model: str, run_id: str = "default"):
        self.spark, self.path = spark, f"{folder}/{stem(model)}__{run_id}"

    def names(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], "name string")
        return self.spark.read.schema("name string").option("recursiveFileLookup", "true").parquet(self.path).select("name").distinct()

    def mark(self, names: DataFrame, batch: str | int) -> None:
        """Add names; the same batch again replaces itself, so a retry changes nothing."""
        names.select(F.col("name").cast("string")).distinct().coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def read_json(self, path: str) -> DataFrame:
        """The names of a JSON array; none where the file is absent or malformed."""
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], "name string")
        return self.spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("name")).distinct()
