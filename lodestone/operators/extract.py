"""Proof extraction, assembly and validation, in reference and strict mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.dialect import SPARK, Dialect


def extract(d: Dialect, raw: str, mode: str = "default") -> str:
    """(strategy, proof) of a completion; strategy 0 and an empty proof where none applies.

    A strategy whose block is rejected passes on to the next strategy, never to
    its own next-best block. The later ones are evaluated only when needed.
    """
    found = lambda k, v: d.pair(strategy=str(k), proof=v)
    none = found(0, "''")
    if mode == "strict":
        last = d.let(t.lean_from_text(d, raw, mode), lambda v: d.case((t.has_proof_body(d, v, mode), found(3, v)), other=none))
        second = d.let(t.best_fence(d, raw, mode), lambda v: d.case((f"{v} <> '' AND {t.has_proof_body(d, v, mode)}", found(2, v)), other=last))
        first = d.let(t.best_fence(d, t.after_think(d, raw), mode), lambda v: d.case((f"{v} <> '' AND {t.has_proof_body(d, v, mode)}", found(1, v)), other=second))
        return d.case((d.contains(raw, "</think>"), first), other=second)
    fenced = lambda x: d.let(x, lambda v: t.strip_markdown(d, t.best_fence(d, v)))
    plain = d.let(t.strip_markdown(d, t.strip_tokens(d, t.strip_think(d, raw))), lambda v: d.case((t.has_proof_body(d, v), found(4, t.strip_trailing_fence(d, v))), other=none))
    third = d.let(t.strip_tokens(d, t.lean_from_text(d, raw)), lambda v: d.case((t.has_proof_body(d, v), found(3, v)), other=plain))
    second = d.let(fenced(t.output_start(d, raw)), lambda v: d.case((t.has_proof_body(d, v), found(2, v)), other=third))
    return d.let(fenced(t.after_think(d, raw)), lambda v: d.case((t.has_proof_body(d, v), found(1, v)), other=second))


def proof_file(d: Dialect, header: str, informal: str, statement: str, proof: str, mode: str = "default") -> str:
    """A problem's parts and a proof body, one below the other."""
    build = t.joined if mode == "strict" else t.sections
    return build(d, header, informal, statement, proof)


def assemble(d: Dialect, header: str, informal: str, statement: str, proof: str, mode: str = "default") -> str:
    """The whole file of a proof: as it is with imports, below the header with a declaration, else below all parts; empty if it does not pass."""
    whole = proof_file(d, header, informal, statement, proof, mode)
    headed = d.case((f"{header} = ''", proof), other=d.concat(header, d.lit("\n"), proof))
    branches = [(f"{proof} = ''", "''"), (d.contains(proof, "import "), proof)]
    if mode != "strict":
        branches.append((t.has_declaration(d, proof), headed))
    return d.let(d.case(*branches, other=whole), lambda v: d.case((t.validate(d, v, mode), v), other="''"))


def last_wins(theorems: DataFrame, order: str) -> DataFrame:
    """One row for each name: the last by the order column."""
    return theorems.groupBy("name").agg(F.max_by(F.struct(*[c for c in theorems.columns if c != "name"]), order).alias("t")).select("name", "t.*")


def re_extract(attempts: DataFrame, theorems: DataFrame, mode: str = "default", order: str | None = None) -> DataFrame:
    """Attempts of known theorems with strategy, proof and lean (empty where nothing valid was found).

    attempts: theorem, raw and other columns; theorems: name, header,
    informal_prefix, formal_statement. Null texts count as empty. Of several
    records of one name the last counts, by the order column or else as they are read.
    """
    parts = ("header", "informal_prefix", "formal_statement")
    place = F.monotonically_increasing_id() if order is None else F.col(order)
    known = last_wins(theorems.select("name", *parts, place.alias("_order")), "_order")
    parts = known.select(F.col("name").alias("theorem"), *[F.coalesce(c, F.lit("")).alias(f"_{c}") for c in parts])
    found = attempts.withColumn("raw", F.coalesce("raw", F.lit(""))).join(parts, "theorem")
    found = found.withColumn("_found", F.expr(extract(SPARK, "raw", mode)))
    found = found.withColumn("strategy", F.col("_found.strategy")).withColumn("proof", F.col("_found.proof"))
    found = found.withColumn("lean", F.expr(assemble(SPARK, "_header", "_informal_prefix", "_formal_statement", "proof", mode)))
    return found.drop("_found", "_header", "_informal_prefix", "_formal_statement")


def recovery(extracted: DataFrame) -> DataFrame:
    """total, recovered and rate (percent, one decimal; 0 without rows)."""
    n, ok = F.count("*"), F.count_if(F.col("lean") != "")
    return extracted.agg(n.alias("total"), ok.alias("recovered"), F.round(F.when(n > 0, ok * 100.0 / n).otherwise(0.0), 1).alias("rate"))
