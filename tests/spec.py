"""What the text operators should do, in plain Python, for the tests."""

import re

# Fixed values, written down here a second time: a wrong one in the package must fail a test.
SPACE = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
NOT_PROOF = "theorem lemma import open set_option noncomputable variable".split()
OPENERS = [f"```{kind}{end}" for kind in ("lean4", "tactics", "") for end in ("\n", "")]
OUTPUT_MARKS = ["<|im_start|>assistant\n", "<｜Assistant｜>", "### Response:\n"]
CHAT_TOKENS = """<|im_end|> <|im_start|> <|endoftext|> <|begin_of_text|> <|end_of_text|> <|eot_id|> </s> <｜User｜> <｜Assistant｜>
<｜begin▁of▁sentence｜> <｜end▁of▁sentence｜> <|EOT|> <|User|> <|Assistant|>""".split()
CHAT_TOKENS[11:11] = ["### Instruction:", "### Response:"]


def trim(s):
    return s.strip(SPACE)


def lines(s):
    parts = re.split("\r?\n", s)
    return parts[:-1] if parts[-1] == "" else parts


def words(s):
    return re.findall(f"[^{SPACE}]+", s)


def proof_body(s):
    w = words(s)
    if not w or w[0] in NOT_PROOF or trim(s).startswith(("```", "#")):
        return False
    return not ("A" <= w[0][0] <= "Z" and len(w) > 4)


def strip_header(s):
    for mark in (":= by\n", ":= by", ":=by"):
        head, found, rest = s.partition(mark)
        if found and proof_body(rest):
            return trim(rest)
    return s


def has_body(s):
    b = trim(strip_header(s))
    return len(b.encode()) >= 2 and b[0] != "`" and "sorry" not in b and proof_body(b)


def markdown(s):
    return "\n".join(x for x in lines(s) if not trim(x).startswith(("#", "**")))


def fence(s):
    best, top = None, 0
    for opener in OPENERS:
        for code in re.findall(re.escape(opener) + "(.*?)```", s, re.S):
            code = trim(code)
            if trim(opener) == "```" and "\n" in code:
                first, _, rest = code.partition("\n")
                if re.fullmatch(f"[{SPACE}]*[\\w-]+[{SPACE}]*", first):
                    code = trim(rest)
            n = len(trim(strip_header(code)).encode())
            if n > top:
                best, top = code, n
    return best


def after_mark(s):
    for m in OUTPUT_MARKS:
        if m in s:
            return s[s.rindex(m) + len(m) :]
    return s


def from_text(s):
    if ":= by" not in s:
        return None
    at = s.index(":= by") + 5
    after = lines(s[at:])
    while after and not trim(after[0]):
        after.pop(0)
    taken = []
    for line in after:
        t = trim(line)
        if not t or t.startswith(("theorem ", "lemma ", "import ")):
            break
        if taken and not (line.startswith((" ", "\t")) or t.startswith(("·", ".", "--"))):
            break
        taken.append(line)
    body = trim("\n".join(taken))
    if not body:
        return None
    before = lines(s[:at])
    first = next((k for k, x in enumerate(before) if "import " in x or "theorem " in x), 0)
    return "\n".join(before[: len(before) - first][::-1]) + "\n  " + body


def think(s):
    while "<think>" in s:
        a, b = s.index("<think>"), s.find("</think>")
        if b < a:
            return s[:a] + s[a + 7 :]
        s = s[:a] + s[b + 8 :]
    return s


def tokens(s):
    for t in CHAT_TOKENS:
        s = s.replace(t, "")
    return s


def comments(s, leak=True):
    out, depth, i = [], 0, 0
    while i < len(s):
        two = s[i : i + 2]
        if two == "/-":
            depth, i = depth + 1, i + 2
        elif depth and two == "-/":
            depth, i = depth - 1, i + 2
        else:
            if not depth:
                out.append(s[i])
            elif leak:
                out.append({"-": "--", "/": "/"}.get(s[i], ""))
            i += 1
    return "".join(out)


def trailing_fence(s):
    t = s.rstrip(SPACE)
    return t[:-3].rstrip(SPACE) if t.endswith("```") else s


def extract(raw):
    for k, part in ((1, raw.partition("</think>")[2] if "</think>" in raw else raw), (2, after_mark(raw))):
        code = fence(part)
        if code is not None and has_body(markdown(code)):
            return k, markdown(code)
    code = from_text(raw)
    if code is not None and has_body(tokens(code)):
        return 3, tokens(code)
    code = markdown(tokens(think(raw)))
    return (4, trailing_fence(code)) if has_body(code) else (0, "")
