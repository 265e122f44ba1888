"""SQL written by hand for the checking database, apart from the operators' own rendering.

It says in another way what a query should return, so that a rule misread in an
operator does not stand in its check, too. Where the views fix what goes in (texts that
are byte-encoded and decoded again, parts without line ends at their borders) it says
the result itself.
"""

from __future__ import annotations

from ..functions.dialect import DUCK
from .fixtures import ctes

#: Unicode white space, as characters of a class.
_WS = "\\x{0009}-\\x{000D}\\x{0020}\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
_FENCE = "`" * 3
#: Fixed values, a second time.
_TOKENS = [
    *"<|im_end|> <|im_start|> <|endoftext|> <|begin_of_text|> <|end_of_text|> <|eot_id|> </s> <｜User｜> <｜Assistant｜>".split(),
    *"<｜begin▁of▁sentence｜> <｜end▁of▁sentence｜>".split(),
    "### Instruction:",
    "### Response:",
    *"<|EOT|> <|User|> <|Assistant|>".split(),
]


def _attempts(sql: str) -> str:
    return f"{ctes(DUCK, '', 'attempts')} {sql}"


def _theorems(sql: str, *more: str) -> str:
    return f"{ctes(DUCK, '', 'theorems', *more)} {sql}"


def _cleaned() -> str:
    x = "raw"
    for token in _TOKENS:
        x = f"replace({x}, '{token}', '')"
    return x


def _below(*parts: str) -> str:
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda x: x <> ''), chr(10))"


ORACLE: dict[str, str] = {
    "served_window": f"{ctes(DUCK, '', 'models')} SELECT name, CASE WHEN max_model_len - max_tokens < 4096 THEN max_model_len ELSE max_tokens + 4096 END AS served_window FROM models",
    "file_stem": f"{ctes(DUCK, '', 'models')} SELECT name, 'org_' || regexp_replace(name, '[/ ]', '_', 'g') || '_v_1' AS stem FROM models",
    "strip_markdown": _attempts(
        "SELECT theorem, attempt_key, coalesce(string_agg(v, chr(10) ORDER BY i) FILTER (WHERE NOT (i = n AND v = '') "
        f"AND NOT regexp_matches(v, '^[{_WS}]*(?:#|[*][*])')), '') AS cleaned "
        "FROM (SELECT theorem, attempt_key, unnest(string_split_regex(raw, '\\r?\\n')) AS v, generate_subscripts(string_split_regex(raw, '\\r?\\n'), 1) AS i, len(string_split_regex(raw, '\\r?\\n')) AS n FROM attempts) "
        "GROUP BY theorem, attempt_key"
    ),
    "strip_chat_tokens": _attempts(f"SELECT theorem, attempt_key, {_cleaned()} AS cleaned FROM attempts"),
    "strip_trailing_fence": _attempts(f"SELECT theorem, attempt_key, regexp_replace(regexp_replace(raw, '[{_WS}]+$', ''), '[{_WS}]*{_FENCE}$', '') AS cleaned FROM attempts"),
    "output_start": _attempts(
        "SELECT theorem, attempt_key, list_last(string_split(raw, CASE WHEN contains(raw, '<|im_start|>assistant' || chr(10)) THEN '<|im_start|>assistant' || chr(10) "
        "WHEN contains(raw, '<｜Assistant｜>') THEN '<｜Assistant｜>' ELSE '### Response:' || chr(10) END)) AS output FROM attempts"
    ),
    "has_declaration": _attempts(f"SELECT theorem, attempt_key, regexp_matches(raw, '(?:^|\\n)[{_WS}]*(?:theorem|lemma) ') AS declared FROM attempts"),
    "strip_think": (
        f"{ctes(DUCK, '', 'attempts').replace('WITH', 'WITH RECURSIVE', 1)}, cut AS ("
        "SELECT theorem, attempt_key, raw AS s, instr(raw, '<think>') AS a, instr(raw, '</think>') AS b, 0 AS k FROM attempts UNION ALL "
        "SELECT theorem, attempt_key, s2, CASE WHEN b > a THEN instr(s2, '<think>') ELSE 0 END, instr(s2, '</think>'), k + 1 FROM "
        "(SELECT *, CASE WHEN b > a THEN left(s, a - 1) || substr(s, b + 8) ELSE left(s, a - 1) || substr(s, a + 7) END AS s2 FROM cut WHERE a > 0)) "
        "SELECT theorem, attempt_key, arg_max(s, k) AS cleaned FROM cut GROUP BY theorem, attempt_key"
    ),
    "byte_decode": _attempts("SELECT theorem, attempt_key, raw AS decoded FROM attempts"),
    "scrub_tokens": _attempts("SELECT theorem, attempt_key, replace(raw, '</s>', '') AS decoded FROM attempts"),
    "decode_for_architecture": _theorems(
        "SELECT t.name, m.name AS model, CASE WHEN m.architecture IN ('raw', 'deepseek_v2', 'deepseek_coder') THEN formal_statement ELSE replace(replace(formal_statement, ' ', 'Ġ'), chr(10), 'Ċ') END AS decoded FROM theorems t, models m",
        "models",
    ),
    "completion_text": _attempts("SELECT theorem, attempt_key, CASE WHEN attempt_index % 4 = 3 THEN theorem || ' ' || attempt_key ELSE '' END AS completion FROM attempts"),
    "theorem_block": _theorems(f"SELECT name, {_below('header', 'informal_prefix', 'formal_statement')} AS block FROM theorems"),
    "proof_file": _theorems(f"""SELECT name, {_below('header', 'informal_prefix', 'formal_statement', "'  rfl'")} AS lean FROM theorems"""),
    "proof_file_stp": _theorems(f"""SELECT name, {_below('header', 'informal_prefix', 'formal_statement', "'  rfl'")} AS lean FROM theorems"""),
    "problem_description": _theorems(f"SELECT name, regexp_replace(regexp_replace(informal_prefix, '^[{_WS}]*/--[{_WS}]*', ''), '[{_WS}]*-/[{_WS}]*$', '') AS description FROM theorems"),
    "seed": _attempts("SELECT theorem, attempt_index, (4294967290::BIGINT + attempt_index) & 4294967295::BIGINT AS seed FROM attempts"),
    "theorem_counts": _attempts("SELECT m AS model, count(*) AS theorems FROM (SELECT DISTINCT ['a', 'b'][1 + attempt_index % 2] AS m, theorem FROM attempts) GROUP BY m"),
    "output_sizes": _attempts("SELECT theorem, CAST(sum(octet_length(encode(raw))) AS BIGINT) AS bytes, round(CAST(sum(octet_length(encode(raw))) AS DOUBLE) / 1000000, 1) AS mb FROM attempts GROUP BY theorem"),
}
