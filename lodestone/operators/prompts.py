"""Prompts of the five formats and the chat templates around them."""

from __future__ import annotations

from ..functions import text as t
from ..functions.dialect import Dialect

#: Sentences of the prompts.
THINK = "Think about and solve the following problem step by step in Lean 4."
COMPLETE = "Complete the following Lean 4 code:\n\n```lean4\n"
COMMENTED = "Complete the following Lean 4 code with explanatory comments preceding each line of code:\n\n```lean4\n"
PLAN = (
    "\nBefore producing the Lean 4 code to formally prove the given theorem, provide a detailed proof plan outlining the main proof steps and strategies.\n"
    "The plan should highlight key ideas, intermediate lemmas, and proof structures that will guide the construction of the final formal proof."
)
FORMATS = ["kimina", "goedel_v2", "goedel_v2_nocot", "simple", "deepseek_prover"]
ARCHITECTURES = ["qwen3", "deepseek_v2", "deepseek_coder", "raw"]


def prompt(d: Dialect, format: str, header: str = "header", informal: str = "informal_prefix", statement: str = "formal_statement") -> str:
    """The user's message in a format; unknown formats are the first one."""
    block = t.sections(d, header, informal, statement)
    if format == "simple":
        return d.concat(d.lit(COMMENTED), block)
    if format in ("goedel_v2", "goedel_v2_nocot"):
        end = d.lit("\n  sorry\n```" + (PLAN if format == "goedel_v2" else ""))
        return d.concat(d.lit(COMPLETE), d.trim(block, side="right"), end)
    if format == "deepseek_prover":
        bare = d.case((d.contains(statement, "sorry"), d.extract(statement, "(?s)^(.*)sorry", 1)), other=statement)
        return d.concat(d.lit(COMPLETE), d.let(d.trim(bare), lambda v: t.sections(d, header, v)))
    told = d.let(t.problem_description(d, informal), lambda v: d.case((f"{v} = ''", "''"), other=d.concat(d.lit("\n# Problem:"), v)))
    return d.concat(d.lit(THINK), told, d.lit("\n# Formal statement:\n```lean4\n"), block, d.lit("\n```"))


def prompt_for(d: Dialect, format: str) -> str:
    """The message in the format that a column names (case does not count)."""
    return d.case(*[(f"lower({format}) = '{f}'", prompt(d, f)) for f in FORMATS[1:]], other=prompt(d, FORMATS[0]))


def chat(d: Dialect, architecture: str, user: str, system: str, format: str = "''") -> str:
    """A message in an architecture's chat template; format: SQL text of the prompt format's name."""
    if architecture == "qwen3":
        head = d.case((f"{system} = ''", "''"), other=d.concat(d.lit("<|im_start|>system\n"), system, d.lit("<|im_end|>\n")))
        return d.concat(head, d.lit("<|im_start|>user\n"), user, d.lit("<|im_end|>\n<|im_start|>assistant\n"))
    if architecture == "deepseek_v2":
        return d.concat(system, d.lit("<｜User｜>"), user, d.lit("<｜Assistant｜>"))
    if architecture == "deepseek_coder":
        opener = t.FENCE + "lean4\n"
        piece = d.substr(user, f"{d.instr(user, opener)} + {len(opener)}")
        piece = d.let(piece, lambda v: d.case((d.contains(v, opener), d.substr(v, 1, f"{d.instr(v, opener)} - 1")), other=v))
        piece = d.let(d.trim(piece, side="right"), lambda v: d.trim(d.case((d.ends(v, t.FENCE), d.substr(v, 1, f"{d.chars(v)} - 3")), other=v), side="right"))
        begun = d.case((d.contains(user, opener), piece), other="''")
        closed = d.case((d.ends(d.trim(user, side="right"), t.FENCE), user), other=d.concat(user, d.lit("\n" + t.FENCE)))
        simple = d.concat(system, d.lit("### Instruction:\n"), closed, d.lit("\n### Response:\n" + opener), begun)
        return d.case((f"{format} = 'simple'", simple), other=d.concat(system, d.lit("### Instruction:\n"), user, d.lit("\n### Response:\n")))
    if architecture == "raw":
        return user
    return d.concat(d.lit("System: "), system, d.lit("\n\nUser: "), user, d.lit("\n\nAssistant: "))


def chat_for(d: Dialect, architecture: str, user: str, system: str, format: str) -> str:
    """The template of the architecture that a column names (case does not count)."""
    return d.case(*[(f"lower({architecture}) = '{a}'", chat(d, a, user, system, format)) for a in ARCHITECTURES], other=chat(d, "", user, system))
