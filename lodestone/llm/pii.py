"""Personal data by weak supervision, in DataFrame functions only.

Candidates come from one strict and some loose patterns for each kind. Six
labelers vote on a candidate: its strict form and its check (checksum, ranges,
digit count) are regex labelers, a gazetteer knows top-level domains, prefixes
and country codes, and context labelers look at the words before it, its
borders and the variety of its characters. Expectation-maximisation estimates
how reliable each labeler's votes are for true and false candidates (those of the
strict base count as true, strict forms that fail their check as false), and its posteriors train the final classifier of
spans, a logistic regression over votes and kinds. Both are fitted on the counts
of vote patterns, a table with at most len(KINDS) * 3**6 rows, so no data but
that table reaches the driver.

Base spans always stay; other candidates are added where the classifier gives
them KEEP or more and they touch no base span. Patterns are linear: a run of
characters is entered at its start (or where the last match ended) and never
given back; matches are put in place in blocks, and spans compared by halving, so
very long texts with very many matches take time in proportion.

Null text counts as empty; null and repeated ids are kept as they are, each row
for itself, and equal texts get equal spans. An empty table gives an empty one.
Columns other than the id and the text are left out, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .fingerprint import let

#: The kinds, as listed in results.
KINDS = ["email", "ip", "card", "phone", "secret"]
#: Probability from which a candidate becomes a span.
KEEP = 0.5
LABELERS = ["form", "check", "gazetteer", "context", "border", "variety"]

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63} ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z]{2,10}",
    "phone": r"(?<![0-9+(.)-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "secret": r"(?<=(?:token|secret|password|passwd|api_key|apikey) {0,2}[=:] {0,2}[\"']?)[^\s\"']{8,}+|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
LOOSE_NEEDS = {"email": r"[\[(](?:at|AT)[\])]", "phone": r"[0-9]{3}[ .-][0-9]{4}", "secret": r"(?:token|secret|passw|api_?key)[a-z]{0,3} {0,2}[=:]|AKIA|gh[pousr]_"}
#: Words that go before data of a kind.
CONTEXT = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|host|server|address",
    "card": "card|visa|credit|account|iban",
    "phone": "phone|tel|call|mobile|fax",
    "secret": "token|secret|passw|key",
}
#: Gazetteers: top-level domains; first digits of card issuers; country codes; forms of issued keys.
GAZETTEER = {
    "email": r"\.(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu|us|ca|it|nl)$",
    "ip": r"^(?!0|10\.|127\.|22[4-9]\.|2[3-9][0-9]\.)",
    "card": "^[3-6]",
    "phone": r"^\+?(?:1|7|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "secret": r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|AKIA.*|gh[pousr]_.*)$",
}


#: Matches that are put in place together: the work for a text grows with its matches times this, not with their square.
BLOCK = 64


def located(text: Column, pattern: str) -> Column:
    """Each leftmost non-overlapping match: start (code points), value, left (up to 32 characters before it, from the match before on) and next (the character behind it).

    All of it comes from the matches and the gaps between them, as a substring of
    a long text by code points would walk through it from its beginning.
    """
    match = "struct<start:int,value:string,left:string,next:string>"

    def build(pair: Column) -> Column:
        found, gaps = pair["found"], pair["gaps"]

        def step(a: Column, i: Column) -> Column:
            at = a["at"] + F.length(F.get(gaps, i))
            value, after = F.get(found, i), F.get(gaps, i + 1)
            left = F.substring(F.concat(F.coalesce(F.get(found, i - 1), F.lit("")), F.get(gaps, i)), -32, 32)
            following = F.substring(F.when(after != "", after).otherwise(F.coalesce(F.get(found, i + 1), F.lit(""))), 1, 1)
            one = F.struct(at.alias("start"), value.alias("value"), left.alias("left"), following.alias("next"))
            return F.struct((at + F.length(value)).alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

        def block(a: Column, k: Column) -> Column:
            start = F.struct(a["at"].alias("at"), F.array().cast(f"array<{match}>").alias("out"))
            own = F.aggregate(F.sequence(k * BLOCK, F.least((k + 1) * BLOCK, F.size(found)) - 1), start, step)
            return let(own, lambda o: F.struct(o["at"].alias("at"), F.concat(a["out"], F.array(o["out"])).alias("out")))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{match}>>").alias("out"))
        blocks = F.aggregate(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")), start, block)
        return F.when(F.size(found) == 0, F.array().cast(f"array<{match}>")).otherwise(F.flatten(blocks["out"]))

    pair = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return let(pair, build)


def below(ordered: Column, x: Column) -> Column:
    """How many numbers of a sorted array are less than x, by halving."""
    steps = F.array(*[F.lit(1 << k) for k in range(29, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.coalesce(F.get(ordered, n + s - 1) < x, F.lit(False)), n + s).otherwise(n))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def step(a: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return a + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), step) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The check that base matches of a kind pass."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return let(digits(value), lambda d: F.length(d).between(14, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    if kind == "secret":
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return value.rlike(r"\.[A-Za-z]{2,}$")


def vote(yes: Column, no: int = -1) -> Column:
    return F.when(yes, F.lit(1)).otherwise(F.lit(no))


def judged(kind: str, text: Column, strict: bool) -> Column:
    """The candidates of a kind: start, order of the kind, end, whether base, votes."""
    pattern, needs = (PATTERNS, NEEDS) if strict else (LOOSE, LOOSE_NEEDS)

    def one(m: Column) -> Column:
        value, start = m["value"], m["start"]
        end = start + F.length(value)
        ok = F.coalesce(valid(kind, value), F.lit(False))
        base = (F.lit(True) if kind == "email" else ok) if strict else F.lit(False)
        left = F.lower(m["left"])
        before, after = F.substring(m["left"], -1, 1), m["next"]
        votes = [
            vote(F.lit(strict)) if kind != "secret" else vote(F.length(value) >= 16),
            vote(ok),
            vote(value.rlike(GAZETTEER[kind])),
            vote(left.rlike(CONTEXT[kind]), 0),
            vote(~(before.rlike("[A-Za-z0-9]") | after.rlike("[A-Za-z0-9]"))),
            vote(F.size(F.array_distinct(F.split(value, ""))) >= 5),
        ]
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), base.alias("base"), F.concat_ws("", *[F.element_at(F.array(*map(F.lit, "-0+")), v + 2) for v in votes]).alias("votes"))

    empty = F.array().cast("array<struct<start:int,kind:int,end:int,base:boolean,votes:string>>")
    need = text.contains(needs[kind]) if needs[kind] == "@" else text.rlike(needs[kind])
    found = F.transform(located(text, pattern[kind]), one)
    if strict and kind == "card":
        found = F.filter(found, lambda c: c["base"] | (c["end"] - c["start"]).between(12, 40))
    return F.when(need, found).otherwise(empty)


def candidates(df: DataFrame, text: str = "text", column: str = "candidates") -> DataFrame:
    """df with the array of candidates."""
    t = F.coalesce(F.col(text), F.lit(""))
    parts = [judged(k, t, True) for k in PATTERNS] + [judged(k, t, False) for k in LOOSE]
    return df.withColumn(column, F.concat(*parts))


def reliabilities(patterns: list[tuple[int, str, bool, int]], rounds: int = 100) -> list[float]:
    """Posterior truth of each (kind, votes, base, count) by expectation-maximisation over independent labelers."""
    if not patterns:
        return []
    n = np.array([p[3] for p in patterns], float)
    seen = np.array([["-0+".index(c) for c in p[1]] for p in patterns])
    base = np.array([p[2] for p in patterns])
    wrong = (seen[:, 0] == 2) & (seen[:, 1] == 0) & (np.array([p[0] for p in patterns]) < KINDS.index("secret"))
    kind = np.array([p[0] for p in patterns])
    truth = np.where(base, 1.0, np.where(wrong, 0.0, np.clip(0.5 + (seen - 1).sum(1) / 12, 0.05, 0.95)))
    for _ in range(rounds):
        odds = np.zeros(len(n))
        for k in range(len(KINDS)):  # the share of true candidates of each kind
            own = kind == k
            odds[own] += np.log(((truth * n)[own].sum() + 1) / (((1 - truth) * n)[own].sum() + 1))
        for j in range(seen.shape[1]):
            for v in range(3):
                own = seen[:, j] == v
                yes = ((truth * n)[own].sum() + 1) / ((truth * n).sum() + 3)
                no = (((1 - truth) * n)[own].sum() + 1) / (((1 - truth) * n).sum() + 3)
                odds[own] += np.log(yes / no)
        new = np.where(base, 1.0, np.where(wrong, 0.0, 1 / (1 + np.exp(-np.clip(odds, -30, 30)))))
        if np.abs(new - truth).max() < 1e-9:
            break
        truth = new
    return truth.tolist()


def classifier(patterns: list[tuple[int, str, bool, int]], truth: list[float], steps: int = 50) -> dict[str, float]:
    """Probability of each "kind:votes" by logistic regression on votes and kinds, trained on the posteriors."""
    if not patterns:
        return {}
    rows = []
    for kind, votes, _, _ in patterns:
        x = [0.0] * (len(KINDS) + 3 * len(LABELERS))
        x[kind] = 1.0
        for j, c in enumerate(votes):
            x[len(KINDS) + 3 * j + "-0+".index(c)] = 1.0
        rows.append(x)
    x, y = np.array(rows), np.array(truth)
    n = np.array([p[3] for p in patterns], float)
    weight, w = n / n.sum(), np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), x.T @ (weight * (p - y)) + 1e-3 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return {f"{k}:{v}": float(q) for (k, v, _, _), q in zip(patterns, p)}


def detect(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base (array of spans) and spans (array of all), each (start, kind, end) in order."""
    found = written(candidates(df.select(doc_id, text)).drop(text), "candidates")
    seen = found.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.base").agg(F.count("*").alias("n"))
    patterns = sorted((r["kind"], r["votes"], r["base"], r["n"]) for r in seen.collect())
    keep = [k for k, p in classifier(patterns, reliabilities(patterns)).items() if p >= KEEP]
    span = lambda c: F.struct(c["start"], c["kind"], c["end"])
    base = F.array_sort(F.transform(F.filter("candidates", lambda c: c["base"]), span))
    ordered = lambda field: F.sort_array(F.transform("base", lambda b: b[field]))
    kept = found.select(doc_id, "candidates", base.alias("base")).withColumns({"starts": ordered("start"), "ends": ordered("end")})
    # no base span overlaps: all that start before the end have ended by the start
    free = lambda c: below(F.col("starts"), c["end"]) == below(F.col("ends"), c["start"] + 1)
    chosen = lambda c: ~c["base"] & F.concat_ws(":", c["kind"].cast("string"), c["votes"]).isin(keep) & free(c)
    added = F.transform(F.filter("candidates", chosen), span)
    return kept.select(doc_id, "base", F.array_sort(F.array_distinct(F.concat("base", added))).alias("spans"))


def as_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns, and n_spans, the number of all spans."""

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(4)]
    return found.select("doc_id", *counts, F.sha2(as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
