"""The model dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.dialect import SPARK, Dialect

SYSTEM = "You are an expert in mathematics and proving theorems in Lean 4."
CHAT_STOPS = ["<|im_end|>", "</s>"]
#: Name, architecture, format, window, max tokens, temperature, top_p, seed, parameters in 10^9, quantisation, system prompt, stops.
MODELS = [
    ("goedel-prover-dpo", "raw", "simple", 4096, 2048, 1.0, 0.95, 1, 7.0, "awq", "", ["<｜end▁of▁sentence｜>", "<|EOT|>", "### Instruction:", "</s>"]),
    ("kimina-prover-rl-1.7b", "qwen3", "kimina", 40960, 8096, 0.6, 0.95, 42, None, None, SYSTEM, CHAT_STOPS),
    ("goedel-prover-v2-8b", "qwen3", "goedel_v2", 40960, 32768, 0.6, 0.95, 30, 8.0, "awq", "", CHAT_STOPS),
    ("deepseek-prover-v2-7b", "deepseek_v2", "goedel_v2_nocot", 65536, 8192, 0.6, 0.95, 30, 7.0, "awq", "", ["<｜end▁of▁sentence｜>", "<｜Assistant｜>", "<｜User｜>", "</s>"]),
    ("kimina-prover-distill-8b", "qwen3", "kimina", 40960, 8096, 0.6, 0.95, 42, 8.0, "awq", "You are an expert in mathematics and Lean 4.", CHAT_STOPS),
    ("stp-model-lean", "raw", "deepseek_prover", 1024, 1024, 1.0, 1.0, 1, None, "awq", "", ["<｜end▁of▁sentence｜>", "</s>"]),
]
COLUMNS = ["name", "architecture", "prompt_format", "max_model_len", "max_tokens", "temperature", "top_p", "seed", "param_count_b", "quantization", "system_prompt", "stop_sequences"]
_TYPES = ["string", "string", "string", "bigint", "bigint", "double", "double", "bigint", "double", "string", "string", None]
#: Tokens that a served window leaves for the prompt.
PROMPT_TOKENS = 4096


def models_sql(d: Dialect) -> str:
    """The registry with its order, as SQL."""

    def value(v, kind: str | None) -> str:
        if isinstance(v, list):
            return d.array(*map(d.lit, v))
        kind = {"string": "varchar"}.get(kind, kind) if d.name == "duck" else kind
        return f"cast({'NULL' if v is None else d.lit(v) if isinstance(v, str) else v} as {kind})"

    rows = []
    for k, m in enumerate(MODELS):
        rows.append("SELECT " + ", ".join(f"{value(v, kind)} AS {c}" for v, c, kind in zip(m, COLUMNS, _TYPES)) + f", cast({k} as int) AS ord")
    return " UNION ALL ".join(rows)


def models(spark: SparkSession) -> DataFrame:
    return spark.sql(models_sql(SPARK))


def find_model(spark: SparkSession, name: str) -> DataFrame:
    """The row of one model; empty for an unknown name."""
    return models(spark).where(f"name = {SPARK.lit(name)}")


def served_window(max_tokens: str = "max_tokens", max_model_len: str = "max_model_len") -> str:
    return f"least({max_tokens} + {PROMPT_TOKENS}, {max_model_len})"
