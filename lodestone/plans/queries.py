"""Registered queries over the driver's tables, and the SQL that checks them.

Text operators are rendered by both dialects; dataflow operators run through the
DataFrame functions of ``lodestone.operators`` and are checked by SQL of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.dialect import DUCK, SPARK, Dialect
from ..operators import extract as ex
from ..operators import jobs, prompts, registry, results
from ..sources import problems
from . import oracles, scratch
from .fixtures import ctes, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Attempts in one document of a theorem in unnest.
BLOCK = 100


def both(name: str, render: Callable[[Dialect, str], str]) -> None:
    """A query that each dialect renders."""
    QUERIES[name] = lambda spark, sf_dir: spark.sql(render(SPARK, sf_dir))
    ORACLE[name] = render(DUCK, "")


def frame(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    """A query by DataFrame functions, checked by SQL of its own."""
    QUERIES[name] = run
    if sql:
        ORACLE[name] = sql


def on_raw(name: str, column: str, op: Callable[..., str]) -> None:
    """A text operator over the raw completions."""
    both(name, lambda d, sf: f"{ctes(d, sf, 'attempts')} SELECT theorem, attempt_key, {op(d, 'raw')} AS {column} FROM attempts")


# the registry
both("models", lambda d, sf: f"{ctes(d, sf, 'models')} SELECT * FROM models")
both("list_models", lambda d, sf: f"{ctes(d, sf, 'models')} SELECT name, ord FROM models")
frame("find_model", lambda s, d: registry.find_model(s, "stp-model-lean").select("name", "architecture", "prompt_format"), f"{ctes(DUCK, '', 'models')} SELECT name, architecture, prompt_format FROM models WHERE name = 'stp-model-lean'")
both("served_window", lambda d, sf: f"{ctes(d, sf, 'models')} SELECT name, {registry.served_window()} AS served_window FROM models")

# text operators
on_raw("strip_markdown", "cleaned", t.strip_markdown)
on_raw("strip_header", "body", t.strip_header)
on_raw("best_fence", "code", t.best_fence)
on_raw("is_proof_body", "ok", t.is_proof_body)
on_raw("has_proof_body", "ok", t.has_proof_body)
on_raw("strip_chat_tokens", "cleaned", t.strip_tokens)
on_raw("output_start", "output", t.output_start)
on_raw("has_declaration", "declared", t.has_declaration)
on_raw("strip_trailing_fence", "cleaned", t.strip_trailing_fence)
on_raw("strip_language", "code", t.strip_language)
on_raw("strip_think", "cleaned", t.strip_think)
on_raw("strip_comments", "cleaned", t.strip_comments)
on_raw("strip_comments_strict", "cleaned", lambda d, x: t.strip_comments(d, x, "strict"))
on_raw("lean_from_text", "code", t.lean_from_text)
on_raw("validate", "ok", t.validate)
on_raw("validate_strict", "ok", lambda d, x: t.validate(d, x, "strict"))
on_raw("byte_decode", "decoded", lambda d, x: d.let(t.byte_encode(d, x), lambda v: t.byte_decode(d, v)))
on_raw("scrub_tokens", "decoded", lambda d, x: t.scrub(d, d.concat(t.byte_encode(d, x), d.lit("[P[PAD]AD]</s><｜end▁of▁sentence｜>"))))
both(
    "decode_for_architecture",
    lambda d, sf: f"{ctes(d, sf, 'theorems', 'models')} SELECT t.name, m.name AS model, {t.decode_for(d, 'm.architecture', t.byte_encode(d, 't.formal_statement'))} AS decoded FROM theorems t CROSS JOIN models m",
)
both(
    "fence_candidates",
    lambda d, sf: f"{ctes(d, sf, 'attempts')}, c AS (SELECT theorem, attempt_key, {t.fence_candidates(d, 'raw')} AS c FROM attempts) "
    f"SELECT theorem, attempt_key, CAST({d.size('c')} AS BIGINT) AS n, CAST({d.greatest_of(d.map('c', lambda v: f'{v}.score'))} AS BIGINT) AS best, {d.join(d.map('c', lambda v: f'{v}.code'), '|')} AS codes FROM c",
)


def _responses(d: Dialect) -> str:
    quoted = d.lit('{"choices":[{"text":')
    odd = d.lit('{"choices":[{"text":5}]}')
    none = d.lit('{"error":"x"}')
    text = d.concat(quoted, d.lit('"'), "theorem", d.lit(" "), "attempt_key", d.lit('"}]}'))
    return d.case(("attempt_index % 4 = 0", odd), ("attempt_index % 4 = 1", none), ("attempt_index % 4 = 2", d.lit("not json")), other=text)


both("completion_text", lambda d, sf: f"{ctes(d, sf, 'attempts')}, r AS (SELECT theorem, attempt_key, {_responses(d)} AS body FROM attempts) SELECT theorem, attempt_key, {t.completion_text(d, 'body')} AS completion FROM r")

# extraction, assembly, validation
_DUCK_PARTS = "t.header, t.informal_prefix, t.formal_statement"


def _extracted(mode: str, theorems: str = "theorems t") -> str:
    return (
        f"{ctes(DUCK, '', 'theorems', 'attempts')}, e AS MATERIALIZED (SELECT a.theorem, a.attempt_key, a.raw, {_DUCK_PARTS}, {ex.extract(DUCK, 'a.raw', mode)} AS x FROM attempts a JOIN {theorems} ON a.theorem = t.name), "
        f"r AS MATERIALIZED (SELECT theorem, attempt_key, CAST(x.strategy AS INT) AS strategy, x.proof AS proof, {ex.assemble(DUCK, 'header', 'informal_prefix', 'formal_statement', 'x.proof', mode)} AS lean FROM e) "
    )


def _re_extract(spark: SparkSession, sf_dir: str, mode: str = "default") -> DataFrame:
    return ex.re_extract(view(spark, sf_dir, "attempts"), view(spark, sf_dir, "theorems"), mode, "item_id").select("theorem", "attempt_key", "strategy", "proof", "lean")


_RATE = "SELECT count(*) AS total, count(*) FILTER (WHERE lean <> '') AS recovered, round(CASE WHEN count(*) > 0 THEN 100.0 * count(*) FILTER (WHERE lean <> '') / count(*) ELSE 0 END, 1) AS rate FROM r"
for _mode, _suffix in (("default", ""), ("strict", "_stp")):
    frame("re_extract" + _suffix, lambda s, d, m=_mode: _re_extract(s, d, m), _extracted(_mode) + "SELECT theorem, attempt_key, strategy, proof, lean FROM r")
    frame("re_extract_rate" + _suffix, lambda s, d, m=_mode: ex.recovery(_re_extract(s, d, m)), _extracted(_mode) + _RATE.replace("round(", "round(CAST(", 1).replace(" END, 1)", " END AS DOUBLE), 1)"))
    frame(
        "extract_strategy_counts" + _suffix,
        lambda s, d, m=_mode: _re_extract(s, d, m).groupBy("strategy").agg(F.count("*").alias("n"), F.count_if(F.col("lean") != "").alias("recovered")),
        _extracted(_mode) + "SELECT strategy, count(*) AS n, count(*) FILTER (WHERE lean <> '') AS recovered FROM r GROUP BY strategy",
    )
# several records of one name: the last one counts
_NAMES = 13
frame(
    "re_extract_dup_names",
    lambda s, d: ex.re_extract(
        view(s, d, "attempts"), view(s, d, "theorems").withColumn("name", F.concat(F.lit("item_"), F.expr(f"item_id % {_NAMES}").cast("string"))), "default", "item_id"
    ).select("theorem", "attempt_key", "strategy", "proof", "lean"),
    _extracted(
        "default",
        f"(SELECT concat('item_', CAST(item_id % {_NAMES} AS VARCHAR)) AS name, arg_max(header, item_id) AS header, arg_max(informal_prefix, item_id) AS informal_prefix, arg_max(formal_statement, item_id) AS formal_statement FROM theorems GROUP BY item_id % {_NAMES}) t",
    )
    + "SELECT theorem, attempt_key, strategy, proof, lean FROM r",
)
for _mode, _suffix in (("default", ""), ("strict", "_stp")):
    both("proof_file" + _suffix, lambda d, sf, m=_mode: f"{ctes(d, sf, 'theorems')} SELECT name, {ex.proof_file(d, 'header', 'informal_prefix', 'formal_statement', d.lit('  rfl'), m)} AS lean FROM theorems")

# prompts and jobs
both("theorem_block", lambda d, sf: f"{ctes(d, sf, 'theorems')} SELECT name, {t.sections(d, 'header', 'informal_prefix', 'formal_statement')} AS block FROM theorems")
both("problem_description", lambda d, sf: f"{ctes(d, sf, 'theorems')} SELECT name, {t.problem_description(d, 'informal_prefix')} AS description FROM theorems")
for _format in prompts.FORMATS:
    both(f"prompt_{_format}", lambda d, sf, f=_format: f"{ctes(d, sf, 'theorems')} SELECT name, {prompts.prompt(d, f)} AS prompt FROM theorems")
for _arch in [*prompts.ARCHITECTURES, "fallback"]:
    both(
        f"chat_{_arch}",
        lambda d, sf, a=_arch: f"{ctes(d, sf, 'theorems')}, u AS (SELECT name, item_id, {prompts.prompt(d, 'simple')} AS u FROM theorems) "
        f"SELECT name, {prompts.chat(d, a, 'u', d.case(('item_id % 2 = 0', d.lit(registry.SYSTEM)), other=d.lit('')), d.case(('item_id % 4 < 2', d.lit('simple')), other=d.lit('kimina')))} AS prompt FROM u",
    )
#: Attempts of each problem in the job queries.
ATTEMPTS = 3
frame(
    "jobs",
    lambda s, d: jobs.plan_jobs(view(s, d, "theorems"), registry.models(s), ATTEMPTS).select("model", "name", "i", "attempt_key", "prompt", "seed", "served_window"),
    f"{ctes(DUCK, '', 'theorems', 'models')} SELECT m.name AS model, t.name, CAST(g.i AS INT) AS i, concat('attempt_', CAST(g.i + 1 AS VARCHAR)) AS attempt_key, "
    f"{prompts.chat_for(DUCK, 'm.architecture', prompts.prompt_for(DUCK, 'm.prompt_format'), 'm.system_prompt', 'm.prompt_format')} AS prompt, {jobs.seed('m.seed', 'g.i')} AS seed, {registry.served_window('m.max_tokens', 'm.max_model_len')} AS served_window "
    f"FROM theorems t CROSS JOIN models m CROSS JOIN range({ATTEMPTS}) g(i)",
)
_FIELDS = "model string, prompt string, max_tokens bigint, temperature double, top_p double, seed bigint, stop array<string>"
frame(
    "request_json",
    lambda s, d: jobs.plan_jobs(view(s, d, "theorems"), registry.models(s), ATTEMPTS).select("model", "name", "i", F.from_json("request", _FIELDS).alias("r"), (F.get_json_object("request", "$.prompt") == F.col("prompt")).alias("same_prompt")).select("model", "name", "i", "same_prompt", "r.max_tokens", "r.temperature", "r.top_p", "r.seed", F.array_join("r.stop", "|").alias("stop")),
    f"{ctes(DUCK, '', 'theorems', 'models')} SELECT m.name AS model, t.name, CAST(g.i AS INT) AS i, true AS same_prompt, m.max_tokens, m.temperature, m.top_p, m.seed + g.i AS seed, array_to_string(m.stop_sequences, '|') AS stop FROM theorems t CROSS JOIN models m CROSS JOIN range({ATTEMPTS}) g(i)",
)
both("seed", lambda d, sf: f"{ctes(d, sf, 'attempts')} SELECT theorem, attempt_index, {jobs.seed('4294967290', 'attempt_index')} AS seed FROM attempts")
frame(
    "micro_batches",
    lambda s, d: jobs.micro_batches(view(s, d, "attempts").select("theorem", F.col("attempt_index").alias("i")), 4),
    f"{ctes(DUCK, '', 'attempts')} SELECT theorem, attempt_index AS i, attempt_index - attempt_index % 4 AS batch_start, 1 + attempt_index - attempt_index % 4 AS batch_seed FROM attempts",
)

# sources, joins and groups
_T = "name, split, informal_prefix, formal_statement, header"
frame("filter_split", lambda s, d: problems.load_jsonl(s, f"{scratch.problem_files(s, d, True)}/raw/all.jsonl", "valid").select(*_T.split(", ")), f"{ctes(DUCK, '', 'theorems')} SELECT {_T} FROM theorems WHERE split = 'valid'")
frame("load_jsonl", lambda s, d: problems.load_jsonl(s, f"{scratch.problem_files(s, d, True)}/raw/all.jsonl"), f"{ctes(DUCK, '', 'theorems')} SELECT {_T}, goal FROM theorems")
_BY_SPLIT = f"SELECT {_T}, CASE WHEN split = 'test' THEN 0 ELSE 1 END AS split_ord FROM theorems"
# from a file of each split, and with one of them missing from the file of all
frame("load_all", lambda s, d: problems.load_all(s, scratch.problem_files(s, d, False))[0].select(*_T.split(", "), "split_ord"), f"{ctes(DUCK, '', 'theorems')} {_BY_SPLIT}")
frame("load_all_fallback", lambda s, d: problems.load_all(s, scratch.problem_files(s, d, True), "all.jsonl")[0].select(*_T.split(", "), "split_ord"), f"{ctes(DUCK, '', 'theorems')} {_BY_SPLIT}")
frame("pending", lambda s, d: results.pending(view(s, d, "theorems"), view(s, d, "done")).select(*_T.split(", ")), f"{ctes(DUCK, '', 'theorems', 'done')} SELECT {_T} FROM theorems WHERE name NOT IN (SELECT name FROM done)")
frame(
    "upsert",
    lambda s, d: results.upsert(
        view(s, d, "attempts").where("attempt_index % 3 <> 0").select("theorem", "attempt_key", "raw"),
        view(s, d, "attempts").where("attempt_index % 3 <> 1").select("theorem", "attempt_key", F.concat("raw", F.lit(" new")).alias("raw")),
    ),
    f"{ctes(DUCK, '', 'attempts')} SELECT theorem, attempt_key, raw || CASE WHEN attempt_index % 3 <> 1 THEN ' new' ELSE '' END AS raw FROM attempts",
)
frame(
    "merge_outer",
    lambda s, d: results.merge_outer(view(s, d, "attempts").where("attempt_index % 3 <> 0"), view(s, d, "attempts").where("attempt_index % 3 <> 1").select("theorem", "attempt_key", F.md5("raw").alias("lean"))),
    f"{ctes(DUCK, '', 'attempts')} SELECT theorem, attempt_key, CASE WHEN attempt_index % 3 <> 0 THEN raw ELSE '' END AS raw, CASE WHEN attempt_index % 3 <> 1 THEN md5(raw) ELSE '' END AS lean FROM attempts",
)
frame(
    "key_union",
    lambda s, d: view(s, d, "theorems").select("name").union(view(s, d, "attempts").select("theorem")).distinct(),
    f"{ctes(DUCK, '', 'theorems', 'attempts')} SELECT name FROM theorems UNION SELECT theorem FROM attempts",
)
frame(
    "complete_groups",
    lambda s, d: results.complete_groups(view(s, d, "attempts").where("attempt_index % 7 <> 3 OR theorem < 'item_2'").select("theorem", "attempt_key"), 5),
    f"{ctes(DUCK, '', 'attempts')}, k AS (SELECT theorem, attempt_key FROM attempts WHERE attempt_index % 7 <> 3 OR theorem < 'item_2') SELECT * FROM k WHERE theorem IN (SELECT theorem FROM k GROUP BY theorem HAVING count(*) >= 5)",
)
frame(
    "last_wins",
    lambda s, d: ex.last_wins(view(s, d, "theorems").withColumn("name", F.expr("concat('item_', cast(item_id % 7 as string))")), "item_id").select("name", "formal_statement", "item_id"),
    f"{ctes(DUCK, '', 'theorems')} SELECT concat('item_', CAST(item_id % 7 AS STRING)) AS name, arg_max(formal_statement, item_id) AS formal_statement, max(item_id) AS item_id FROM theorems GROUP BY item_id % 7",
)
frame(
    "status",
    lambda s, d: results.done_counts(registry.models(s), view(s, d, "checkpoint")),
    f"{ctes(DUCK, '', 'checkpoint')} SELECT m.name, m.ord, count(c.name) AS total_done FROM models m LEFT JOIN checkpoint c ON c.model = m.name GROUP BY m.name, m.ord",
)
both("theorem_counts", lambda d, sf: f"{ctes(d, sf, 'attempts')} SELECT CASE WHEN attempt_index % 2 = 0 THEN 'a' ELSE 'b' END AS model, count(DISTINCT theorem) AS theorems FROM attempts GROUP BY 1")
frame("skip_n", lambda s, d: results.skip(view(s, d, "theorems"), 7, "item_id").select("name"), f"{ctes(DUCK, '', 'theorems')} SELECT name FROM theorems ORDER BY item_id OFFSET 7")
frame("sorted_names", lambda s, d: results.numbered(view(s, d, "done"), "name"), f"{ctes(DUCK, '', 'done')} SELECT name, row_number() OVER (ORDER BY name) AS place FROM done")
both("file_stem", lambda d, sf: f"{ctes(d, sf, 'models')} SELECT name, {results.file_stem(d.concat(d.lit('org/'), 'name', d.lit(' v 1')))} AS stem FROM models")
both("output_sizes", lambda d, sf: f"{ctes(d, sf, 'attempts')} SELECT theorem, CAST(sum({d.octets('raw')}) AS BIGINT) AS bytes, round(CAST(CAST(sum({d.octets('raw')}) AS BIGINT) AS DOUBLE) / 1e6, 1) AS mb FROM attempts GROUP BY theorem")

# nested documents
frame(
    "nest",
    lambda s, d: results.nest(view(s, d, "attempts").select("theorem", "attempt_key", F.md5("raw").alias("v")), "v").select("theorem", F.to_json("attempts").alias("attempts")),
    f"{ctes(DUCK, '', 'attempts')} SELECT theorem, concat('{{', string_agg(concat('\"', attempt_key, '\":\"', md5(raw), '\"'), ',' ORDER BY attempt_key), '}}') AS attempts FROM attempts GROUP BY theorem",
)
frame(
    "unnest",
    lambda s, d: results.unnest(results.documents(view(s, d, "attempts"), "m", "raw", F.floor(F.col("attempt_index") / BLOCK)), "m"),
    f"{ctes(DUCK, '', 'attempts')} SELECT theorem, attempt_key, raw AS value FROM attempts",
)
# one nested document of each kind of text in a file, read again: the sink's column pick
for _kind, _value in (("raw", "theorem || ' ' || attempt_key"), ("lean", "md5(theorem || ' ' || attempt_key)")):
    frame(
        f"stored_{_kind}",
        lambda s, d, k=_kind: scratch.stored(s, d, k),
        f"{ctes(DUCK, '', 'attempts')} SELECT theorem, attempt_key, {_value} AS value FROM attempts",
    )
# names marked done in overlapping batches, one of them twice: a set
frame("done_set", lambda s, d: scratch.done_set(s, d), f"{ctes(DUCK, '', 'theorems')} SELECT DISTINCT name FROM theorems WHERE item_id % 5 <> 4")

# a whole run with a backend that answers by the request's seed: text, an error body, no text
_ANSWER = "CASE (m.seed + g.i) % 3 WHEN 0 THEN concat(chr(96), chr(96), chr(96), 'lean4', chr(10), '  rfl', chr(10), chr(96), chr(96), chr(96)) ELSE '' END"
frame(
    "generate",
    lambda s, d: scratch.generated(s, d, ATTEMPTS),
    f"{ctes(DUCK, '', 'theorems', 'models')}, a AS MATERIALIZED (SELECT t.*, m.name AS model, concat('attempt_', CAST(g.i + 1 AS VARCHAR)) AS attempt_key, {_ANSWER} AS raw FROM theorems t JOIN models m ON m.name = '{scratch.MODEL}' CROSS JOIN range({ATTEMPTS}) g(i)), "
    "p AS MATERIALIZED (SELECT *, CASE WHEN raw = '' THEN '' ELSE 'rfl' END AS proof FROM a) "
    f"SELECT model, name AS theorem, attempt_key, raw, proof, {ex.assemble(DUCK, 'header', 'informal_prefix', 'formal_statement', 'proof')} AS lean FROM p",
)
# where SQL of its own says what an operator does, that is the check
ORACLE.update(oracles.ORACLE)
