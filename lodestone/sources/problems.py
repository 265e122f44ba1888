"""Problem records from JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED = ["name", "split", "formal_statement"]
OPTIONAL = ["informal_prefix", "header", "goal"]
FIELDS = ["name", "split", "informal_prefix", "formal_statement", "header", "goal"]
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FIELDS])
#: The file that holds all splits, unless another name is given.
COMBINED = "problems.jsonl"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_jsonl(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Records of a file, of one split if given.

    A malformed line or a record without a required field fails the read; blank
    lines are skipped, unknown fields ignored, absent optional ones empty.
    """
    rows = spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(path)
    checked = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a record lacks {c}"))).otherwise(F.col(c)).alias(c) if c in REQUIRED else F.coalesce(c, F.lit("")).alias(c) for c in FIELDS]
    rows = rows.select(checked)
    return rows.where(F.col("split") == split) if split else rows


def load_split(spark: SparkSession, data_dir: str, split: str, combined: str = COMBINED) -> DataFrame:
    """The split's own file if it has records (whatever split they name), else those of the combined file."""
    own = f"{data_dir}/raw/{split}.jsonl"
    if exists(spark, own):
        rows = load_jsonl(spark, own)
        if not rows.isEmpty():
            return rows
    every = f"{data_dir}/raw/{combined}"
    if exists(spark, every):
        return load_jsonl(spark, every, split)
    raise FileNotFoundError(f"no records of split {split} below {data_dir}/raw")


def load_all(spark: SparkSession, data_dir: str, combined: str = COMBINED) -> tuple[DataFrame, list[str]]:
    """Records of the splits test and valid, in that order (split_ord), duplicates kept; and the warnings of splits that failed.

    Fails only if nothing was loaded and a split failed.
    """
    out, warnings = None, []
    for k, split in enumerate(("test", "valid")):
        try:
            rows = load_split(spark, data_dir, split, combined).withColumn("split_ord", F.lit(k))
            rows.isEmpty()
        except Exception as e:  # the store's and the parser's errors alike are warnings here
            warnings.append(f"{split}: {e}")
            continue
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("; ".join(warnings))
    return out, warnings
