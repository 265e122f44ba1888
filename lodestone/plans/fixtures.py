"""Views over the driver's tables that stand for problems, attempts and done-sets.

The text is valid in Spark and in the checking database, so both see one input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.dialect import SPARK, Dialect
from ..operators.registry import models_sql

#: Theorems that the attempts are dealt to.
THEOREMS = 40


def ctes(d: Dialect, sf_dir: str, *names: str) -> str:
    """A WITH clause that defines the views named."""
    views = {
        "models": models_sql(d),
        "theorems": f"""SELECT concat('item_', CAST(item_id AS STRING)) AS name,
 CASE WHEN item_id % 2 = 0 THEN 'test' ELSE 'valid' END AS split,
 CASE WHEN item_id % 3 = 0 THEN '' ELSE concat('/-- ', text, ' -/') END AS informal_prefix,
 concat('theorem item_', CAST(item_id AS STRING), ' (n : Nat) : n = n := by') AS formal_statement,
 CASE WHEN item_id % 5 = 0 THEN '' ELSE concat('import Mathlib', chr(10), 'open Nat') END AS header,
 '' AS goal, item_id
FROM {d.table(sf_dir, "benchmark")}""",
        "bare": f"""SELECT doc_id, text AS t, chr(10) AS nl, concat(chr(96), chr(96), chr(96)) AS f,
  concat('item_', CAST(doc_id % {THEOREMS} AS STRING)) AS theorem,
  CAST(floor(doc_id / {THEOREMS}) AS BIGINT) AS attempt_index,
  concat('theorem item_', CAST(doc_id % {THEOREMS} AS STRING), ' (n : Nat) : n = n := by') AS st
 FROM {d.table(sf_dir, "documents")}""",
        "attempts": """SELECT theorem, attempt_index, concat('attempt_', CAST(attempt_index + 1 AS STRING)) AS attempt_key,
 CASE doc_id % 16
  WHEN 0 THEN concat('<think>', t, '</think>', nl, f, 'lean4', nl, 'import Mathlib', nl, st, nl, '  rfl', nl, f)
  WHEN 1 THEN concat(f, 'lean4', nl, st, nl, '  simp', nl, f)
  WHEN 2 THEN concat(f, 'lean4', nl, '  norm_num', nl, f, nl, t)
  WHEN 3 THEN concat('  omega', nl, f)
  WHEN 4 THEN concat(f, 'lean4', nl, st, nl, '  sorry', nl, f)
  WHEN 5 THEN t
  WHEN 6 THEN concat(f, 'lean4', nl, st, nl, '  /- trivial proof -/', nl, f)
  WHEN 7 THEN concat(f, 'lean4', nl, st, nl, '  /- well-known -/', nl, f)
  WHEN 8 THEN concat(f, nl, 'rfl', nl, 'simp', nl, f)
  WHEN 9 THEN concat('Proof:', nl, st, nl, '  rfl')
  WHEN 10 THEN concat(f, 'lean4', nl, 'theorem q : 1 = 1 :=by rfl', nl, f)
  WHEN 11 THEN concat(f, 'lean4', nl, '  rfl', nl, f, nl, t, nl, f, 'lean4', nl, '  simp', nl, f)
  WHEN 12 THEN concat('<think>', t, nl, f, 'lean4', nl, st, nl, '  have h : n = n := by', nl, '    rfl', nl, '  exact h', nl, '# note', nl, f)
  WHEN 13 THEN concat('<|im_start|>user', nl, f, 'lean4', nl, st, nl, '  sorry', nl, f, '<|im_end|>', nl, '<|im_start|>assistant', nl, f, 'tactics', nl, '  linarith', nl, f, '<|im_end|>')
  WHEN 14 THEN ''
  ELSE concat('### Detailed', nl, t, nl, '**bold**')
 END AS raw
FROM bare""",
        # theorems of which a larger share of the labels is good than of all labels
        "done": f"""SELECT concat('item_', CAST(doc_id % (SELECT count(*) FROM {d.table(sf_dir, "benchmark")}) AS STRING)) AS name
 FROM {d.table(sf_dir, "labels")} GROUP BY 1
 HAVING count(CASE WHEN quality = 1 THEN 1 END) * (SELECT count(*) FROM {d.table(sf_dir, "labels")}) > count(*) * (SELECT count(*) FROM {d.table(sf_dir, "labels")} WHERE quality = 1)""",
        "checkpoint": "SELECT m.name AS model, d.name AS name FROM models m JOIN done d ON (length(d.name) + m.ord) % 2 = 0 AND m.ord < 5",
    }
    need = list(names)
    if "attempts" in need:
        need.append("bare")
    if "checkpoint" in need:
        need += ["models", "done"]
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in views.items() if k in need)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(f"{ctes(SPARK, sf_dir, name)} SELECT * FROM {name}")
