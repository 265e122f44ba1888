"""Text operators on completions, as expressions of a dialect.

Each function takes a dialect and the SQL text of its input and returns SQL
text; ``column`` wraps one as a Spark Column. ``mode`` is "strict" for the
behaviour of the lightweight runner, "default" for that of the batch pipeline.
Lengths in thresholds are bytes by default and characters in strict mode.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dialect import SPACE, SPARK, Dialect

FENCE = "```"
#: Fence openers in order; words that begin no proof; tokens that end up in completions.
OPENERS = ["```lean4\n", "```lean4", "```tactics\n", "```tactics", "```\n", "```"]
NOT_PROOF = ["theorem", "lemma", "import", "open", "set_option", "noncomputable", "variable"]
CHAT_TOKENS = [
    "<|im_end|>",
    "<|im_start|>",
    "<|endoftext|>",
    "<|begin_of_text|>",
    "<|end_of_text|>",
    "<|eot_id|>",
    "</s>",
    "<｜User｜>",
    "<｜Assistant｜>",
    "<｜begin▁of▁sentence｜>",
    "<｜end▁of▁sentence｜>",
    "### Instruction:",
    "### Response:",
    "<|EOT|>",
    "<|User|>",
    "<|Assistant|>",
]
OUTPUT_MARKS = ["<|im_start|>assistant\n", "<｜Assistant｜>", "### Response:\n"]
REJECTED_TOKENS = ["<|im_start|>", "<|im_end|>", "<｜User｜>", "<｜Assistant｜>"]
SCRUBBED = ["<｜end▁of▁sentence｜>", "<｜begin▁of▁sentence｜>", "</s>", "<｜end of sentence｜>"]
PADDING = "[PAD]"

_SPACES = SPACE
_WORD = f"[^{SPACE}]+"


def column(op, *inputs: str, **options) -> Column:
    """The operator on columns (or SQL texts) as a Spark Column."""
    return F.expr(op(SPARK, *inputs, **options))


def measure(d: Dialect, x: str, mode: str) -> str:
    return d.chars(x) if mode == "strict" else d.octets(x)


def append_section(d: Dialect, text: str, section: str) -> str:
    """section below text, with a line end between unless there is one or either is empty."""
    plain = f"{text} = '' OR {d.ends(text, chr(10))} OR {d.starts(section, chr(10))}"
    return d.case((f"{section} = ''", text), (plain, d.concat(text, section)), other=d.concat(text, d.lit("\n"), section))


def sections(d: Dialect, *parts: str) -> str:
    """All parts, one below the other."""
    out = parts[0]
    for part in parts[1:]:
        out = d.let(out, lambda v, part=part: append_section(d, v, part))
    return out


def joined(d: Dialect, *parts: str) -> str:
    """The parts that are not empty, joined by line ends."""
    return d.join(d.keep(d.array(*parts), lambda v: f"{v} <> ''"), "\n")


def problem_description(d: Dialect, prefix: str) -> str:
    """The inside of a doc comment, or the whole, trimmed."""
    inside = d.trim(d.substr(prefix, 4, f"{d.chars(prefix)} - 5"))
    return d.case((f"{d.starts(prefix, '/--')} AND {d.ends(prefix, '-/')}", d.case((f"{d.chars(prefix)} > 5", inside), other="''")), other=d.trim(prefix))


def strip_markdown(d: Dialect, x: str) -> str:
    """Lines that are no headings and do not begin in bold."""
    return d.join(d.keep(d.lines(x), lambda v: d.let(d.trim(v), lambda t: f"NOT ({d.starts(t, '#')} OR {d.starts(t, '**')})")), "\n")


def is_proof_body(d: Dialect, x: str, mode: str = "default") -> str:
    """Whether a text begins like tactics: no declaration, fence or heading, and no sentence of over four words."""
    upper = r"^\p{Lu}" if mode == "strict" else "^[A-Z]"

    def body(t: str) -> str:
        first = d.extract(t, f"^({_WORD})", 1)
        words = ", ".join(map(d.lit, NOT_PROOF))
        prose = f"({d.matches(t, upper)} AND {d.matches(t, f'^(?:{_WORD}[{_SPACES}]+){{4}}[^{_SPACES}]')})"
        return f"({t} <> '' AND NOT ({first} IN ({words}) OR {d.starts(t, FENCE)} OR {d.starts(t, '#')} OR {prose}))"

    return d.let(d.trim(x), body)


def strip_header(d: Dialect, x: str, mode: str = "default") -> str:
    """What follows the first `:= by`, if it is a proof body; else the text as it is."""
    out = x
    for mark in (":=by", ":= by", ":= by\n"):  # the last is tried first

        def one(v: str, mark=mark, rest=out) -> str:
            ok = f"{d.contains(x, mark)} AND {is_proof_body(d, v, mode)}"
            return d.case((ok, v), other=rest)

        out = d.let(d.trim(d.substr(x, f"{d.instr(x, mark)} + {len(mark)}")), one)
    return out


def has_proof_body(d: Dialect, x: str, mode: str = "default") -> str:
    def ok(t: str) -> str:
        return f"({measure(d, t, mode)} >= 2 AND NOT {d.starts(t, '`')} AND NOT {d.contains(t, 'sorry')} AND {is_proof_body(d, t, mode)})"

    return d.let(x, lambda v: d.let(d.trim(strip_header(d, v, mode)), ok))


def strip_language(d: Dialect, x: str) -> str:
    """Drop a first line that is one word (a fence's language)."""
    kind = rf"^[{_SPACES}]*[\p{{L}}\p{{M}}\p{{N}}_-]+[{_SPACES}]*$"
    line = d.substr(x, 1, f"{d.instr(x, chr(10))} - 1")
    rest = d.trim(d.substr(x, f"{d.instr(x, chr(10))} + 1"))
    return d.case((f"{d.contains(x, chr(10))} AND {d.matches(line, kind)}", rest), other=x)


def fence_candidates(d: Dialect, x: str, mode: str = "default") -> str:
    """Array of (code, score) of all fenced blocks, by opener and place."""
    lists = []
    for opener in OPENERS:
        found = d.extract_all(x, f"(?s){re.escape(opener)}(.*?){FENCE}", 1)

        def one(v: str, bare=opener.strip() == FENCE) -> str:
            code = d.trim(v)
            code = d.let(code, lambda c: strip_language(d, c)) if bare else code
            return d.let(code, lambda c: d.pair(code=c, score=measure(d, d.trim(strip_header(d, c, mode)), mode)))

        lists.append(d.map(found, one))
    if d.name == "spark":
        return f"concat({', '.join(lists)})"
    return f"flatten([{', '.join(lists)}])"


def best_fence(d: Dialect, x: str, mode: str = "default") -> str:
    """The first block of the highest score over 0, or null."""

    def pick(c: str) -> str:
        top = d.greatest_of(d.map(c, lambda v: f"{v}.score"))
        first = d.let(top, lambda m: f"{d.item(d.keep(c, lambda v: f'{v}.score = {m} AND {m} > 0'), '1')}")
        return d.case((f"{d.size(c)} > 0", f"{first}.code"), other="NULL")

    return d.let(fence_candidates(d, x, mode), pick)


def output_start(d: Dialect, x: str) -> str:
    """What follows the last mark of the first kind of output mark there is; else the whole."""
    return d.case(*[(d.contains(x, m), d.extract(x, f"(?s)^.*{re.escape(m)}(.*)", 1)) for m in OUTPUT_MARKS], other=x)


def strip_tokens(d: Dialect, x: str, tokens: list[str] = CHAT_TOKENS) -> str:
    for t in tokens:
        x = d.replace(x, t)
    return x


def strip_trailing_fence(d: Dialect, x: str) -> str:
    short = d.trim(x, side="right")
    return d.let(short, lambda t: d.case((d.ends(t, FENCE), d.trim(d.substr(t, 1, f"{d.chars(t)} - 3"), side="right")), other=x))


def after_think(d: Dialect, x: str) -> str:
    """What follows the first closing think tag; else the whole."""
    return d.case((d.contains(x, "</think>"), d.substr(x, f"{d.instr(x, '</think>')} + 8")), other=x)


def strip_think(d: Dialect, x: str) -> str:
    """Cut think spans from the front; an unclosed tag is removed and ends it."""
    o, c = "<think>", "</think>"

    def step(s: str, _: str) -> str:  # the state is a flag (1: done) and the text
        def on(t: str) -> str:
            a, b = d.instr(t, o), d.instr(t, c)
            cut = d.concat("'0'", d.substr(t, 1, f"{a} - 1"), d.substr(t, f"{b} + 8"))
            tag = d.concat("'1'", d.substr(t, 1, f"{a} - 1"), d.substr(t, f"{a} + 7"))
            return d.case((f"{a} > 0 AND {b} > 0 AND {a} < {b}", cut), (f"{a} > 0", tag), other=d.concat("'1'", t))

        return d.case((d.starts(s, "1"), s), other=d.let(d.substr(s, 2), on))

    rounds = d.map(f"sequence(1, cast({d.chars(x)} div 15 as int) + 1)" if d.name == "spark" else f"range({d.chars(x)} // 15 + 1)", lambda v: "''")
    return d.case((d.contains(x, o), d.substr(d.fold(rounds, d.concat("'0'", x), step), 2)), other=x)


#: Tokens that strip_comments folds together: its work grows with a text's length times this, not with its square.
BLOCK = 128
#: Digits of a nesting depth; a text of 2 GB, the longest there is, cannot nest deeper.
DEPTH = 10


def strip_comments(d: Dialect, x: str, mode: str = "default") -> str:
    """Remove nested block comments. By default a lone `-` inside one leaves `--`, and a lone `/` itself."""
    tokens = d.extract_all(x, "[-/]|[^-/]+", 0)

    def marked(ts: str) -> str:  # each token behind the first character of the next
        return d.map_at(ts, lambda t, i: d.concat(f"coalesce(substr({d.item(ts, f'({i} + 1)')}, 1, 1), ' ')", t))

    def step(s: str, v: str) -> str:  # state: depth, skip flag, output
        depth, skip, out = d.substr(s, 1, DEPTH), d.substr(s, DEPTH + 1, 1), d.substr(s, DEPTH + 2)
        nxt, tok = d.substr(v, 1, 1), d.substr(v, 2)
        move = lambda by: f"lpad(cast(cast({depth} as bigint) {by} as {'string' if d.name == 'spark' else 'varchar'}), {DEPTH}, '0')"
        leak = (lambda t: d.concat(depth, "'0'", out)) if mode == "strict" else (lambda t: d.concat(depth, "'0'", out, d.lit(t)))
        return d.case(
            (f"{skip} = '1'", d.concat(depth, "'0'", out)),
            (f"{tok} = '/' AND {nxt} = '-'", d.concat(move("+ 1"), "'1'", out)),
            (f"{depth} = '{'0' * DEPTH}'", d.concat(depth, "'0'", out, tok)),
            (f"{tok} = '-' AND {nxt} = '/'", d.concat(move("- 1"), "'1'", out)),
            (f"{tok} = '-'", leak("--")),
            (f"{tok} = '/'", leak("/")),
            other=d.concat(depth, "'0'", out),
        )

    def fold(ts: str) -> str:  # blocks of tokens: the whole output is copied once for each block
        starts = f"sequence(1, {d.size(ts)}, {BLOCK})" if d.name == "spark" else f"range(1, {d.size(ts)} + 1, {BLOCK})"
        places = d.map(starts, lambda k: f"cast({k} as {'string' if d.name == 'spark' else 'varchar'})")

        def block(s: str, k: str) -> str:
            size = f"least({BLOCK}, {d.size(ts)} - cast({k} as int) + 1)"
            own = d.fold(d.slice(ts, f"cast({k} as int)", size), d.substr(s, 1, DEPTH + 1), step)
            return d.let(own, lambda o: d.concat(d.substr(o, 1, DEPTH + 1), d.substr(s, DEPTH + 2), d.substr(o, DEPTH + 2)))

        return d.fold(places, f"'{'0' * (DEPTH + 1)}'", block)

    clean = d.substr(d.let(d.let(tokens, marked), fold), DEPTH + 2)
    return d.case((d.contains(x, "/-"), clean), other=x)


def lean_from_text(d: Dialect, x: str, mode: str = "default") -> str:
    """Tactic lines after the first `:= by` of unfenced text; by default below their context. Null if there are none."""
    if mode == "strict":
        lines = f"split({d.substr(x, f'{d.instr(x, ":= by")} + 5')}, '\\n', -1)" if d.name == "spark" else f"string_split({d.substr(x, f'{d.instr(x, ":= by")} + 5')}, chr(10))"
    else:
        lines = d.lines(d.substr(x, f"{d.instr(x, ':= by')} + 5"))
    boundary = lambda t: f"({d.starts(t, 'theorem ')} OR {d.starts(t, 'lemma ')} OR {d.starts(t, 'import ')})"

    def stops(v: str) -> str:
        goes_on = f"({d.starts(v, ' ')} OR {d.starts(v, chr(9))} OR {{0}})"
        return d.let(d.trim(v), lambda t: f"({t} = '' OR {boundary(t)} OR NOT " + goes_on.format(" OR ".join(d.starts(t, s) for s in ("·", ".", "--"))) + ")")

    def taken(ls: str) -> str:  # from the first line that is not blank
        first = d.item(ls, "1")
        rest = d.slice(ls, "2", d.size(ls))
        stop = d.position(d.map(rest, stops), "true")
        body = d.let(stop, lambda k: d.slice(ls, "1", d.case((f"{k} > 0", k), other=d.size(ls))))
        return d.case((boundary(d.trim(first)), "NULL"), other=d.trim(d.join(body, "\n")))

    def skip_blank(ls: str) -> str:
        at = d.position(d.map(ls, lambda v: f"{d.trim(v)} <> ''"), "true")
        return d.let(at, lambda k: d.case((f"{k} > 0", d.let(d.slice(ls, k, d.size(ls)), taken)), other="NULL"))

    tactics = d.let(lines, skip_blank)
    if mode == "strict":
        return d.case((d.contains(x, ":= by"), tactics), other="NULL")
    before = d.lines(d.substr(x, 1, f"{d.instr(x, ':= by')} + 4"))

    def context(ls: str) -> str:  # the first lines, as many as stand from the earliest declaration on, in reverse
        k = d.position(d.map(ls, lambda v: f"({d.contains(v, 'import ')} OR {d.contains(v, 'theorem ')})"), "true")
        return d.let(k, lambda k: d.join(d.reverse(d.slice(ls, "1", f"{d.size(ls)} - {d.case((f'{k} > 0', f'{k} - 1'), other='0')}")), "\n"))

    whole = d.let(tactics, lambda t: d.case((f"{t} <> ''", d.concat(d.let(before, context), d.lit("\n  "), t)), other="NULL"))
    return d.case((d.contains(x, ":= by"), whole), other="NULL")


def has_declaration(d: Dialect, x: str) -> str:
    """Whether a line begins with a theorem or lemma."""
    found = d.keep(d.lines(x), lambda v: d.let(d.trim(v, side="left"), lambda t: f"({d.starts(t, 'theorem ')} OR {d.starts(t, 'lemma ')})"))
    return f"({d.size(found)} > 0)"


def validate(d: Dialect, code: str, mode: str = "default") -> str:
    """Whether code is a whole file with a proof after the first `:= by`."""

    def ok(b: str) -> str:
        bad = [FENCE, "**", *REJECTED_TOKENS]
        clean = d.trim(strip_comments(d, b, mode))
        return f"({measure(d, b, mode)} >= 2 AND NOT ({' OR '.join(d.contains(b, s) for s in bad)}) AND {is_proof_body(d, b, mode)} AND {measure(d, clean, mode)} >= 2)"

    body = d.let(d.trim(d.substr(code, f"{d.instr(code, ':= by')} + 5")), ok)
    return d.case((f"{code} = '' OR NOT {d.contains(code, ':= by')} OR {d.contains(code, 'sorry')}", "false"), other=body)


def completion_text(d: Dialect, body: str) -> str:
    """choices[0].text of a response, or empty where it is no string."""
    if d.name == "spark":
        v = f"try_parse_json({body})"
        return f"CASE WHEN schema_of_variant(try_variant_get({v}, '$.choices[0].text', 'variant')) = 'STRING' THEN try_variant_get({v}, '$.choices[0].text', 'string') ELSE '' END"
    return f"CASE WHEN json_valid({body}) THEN CASE WHEN json_type({body}, '$.choices[0].text') = 'VARCHAR' THEN json_extract_string({body}, '$.choices[0].text') ELSE '' END ELSE '' END"


# byte-level text


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, the rest from U+0100 on in byte order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def byte_decode(d: Dialect, x: str) -> str:
    """Characters that stand for bytes as those bytes, others as their own; malformed UTF-8 becomes U+FFFD."""
    rest = [b for c, b in sorted(byte_characters().items()) if ord(c) >= 0x100]

    def hexed(c: str) -> str:
        def of(k: str) -> str:
            number = f"hex({k})" if d.name == "spark" else f"printf('%02X', {k})"
            plain = f"{k} BETWEEN 33 AND 126 OR {k} BETWEEN 161 AND 172 OR {k} BETWEEN 174 AND 255"
            moved = d.item(d.array(*[f"'{b:02X}'" for b in rest]), f"({k} - 255)")
            own = f"hex(encode({c}, 'UTF-8'))" if d.name == "spark" else f"hex(encode({c}))"
            return d.case((plain, number), (f"{k} BETWEEN 256 AND {255 + len(rest)}", moved), other=own)

        return d.let(f"ascii({c})" if d.name == "spark" else f"unicode({c})", of)

    if d.name == "spark":
        return f"CASE WHEN {x} = '' THEN '' ELSE make_valid_utf8(cast(unhex(array_join({d.map(f"split({x}, '')", hexed)}, '')) as string)) END"
    return f"CASE WHEN {x} = '' THEN '' ELSE decode(unhex(array_to_string({d.map(f"string_split({x}, '')", hexed)}, ''))) END"


def byte_encode(d: Dialect, x: str) -> str:
    """The characters that stand for the bytes of a text: the inverse of byte_decode."""
    of = {b: c for c, b in byte_characters().items()}
    table = d.array(*[d.lit(of[b]) for b in range(256)])
    if d.name == "spark":
        return f"array_join(transform(regexp_extract_all(hex(encode({x}, 'UTF-8')), '(..)', 1), h -> get({table}, cast(conv(h, 16, 10) as int))), '')"
    return f"array_to_string(list_transform(regexp_extract_all(hex(encode({x})), '(..)', 1), lambda h: ({table})[CAST('0x' || h AS INT) + 1]), '')"


def decode_for(d: Dialect, architecture: str, x: str) -> str:
    """byte_decode for the architectures whose servers return byte-level text (case counts)."""
    return d.case((f"{architecture} IN ('raw', 'deepseek_v2', 'deepseek_coder')", byte_decode(d, x)), other=x)


def scrub(d: Dialect, x: str) -> str:
    """Special tokens removed (padding until none is left), then byte_decode."""

    def step(s: str, _: str) -> str:  # the state is a flag (1: done) and the text
        cleaned = lambda t: d.let(d.replace(t, PADDING), lambda r: d.case((f"{r} = {t}", d.concat("'1'", t)), other=d.concat("'0'", r)))
        return d.case((d.starts(s, "1"), s), other=d.let(d.substr(s, 2), cleaned))

    rounds = lambda v: d.map(f"sequence(1, cast({d.chars(v)} div 5 as int) + 1)" if d.name == "spark" else f"range({d.chars(v)} // 5 + 1)", lambda _: "''")
    bare = d.let(strip_tokens(d, x, SCRUBBED), lambda v: d.case((d.contains(v, PADDING), d.substr(d.fold(rounds(v), d.concat("'0'", v), step), 2)), other=v))
    return d.let(bare, lambda v: byte_decode(d, v))
