import random

import pytest
import spec
from pyspark.sql import functions as F

from lodestone.functions import text as t
from lodestone.functions.dialect import SPARK
from lodestone.operators import extract as ex

MARKS = ["```", "```lean4\n", "```tactics\n", "```\n", ":= by", ":= by\n", ":=by", "<think>", "</think>", "\n", "\r\n", " ", "  ", "sorry", "theorem a : b ", "import Mathlib", "# h", "**b**", "rfl", "simp", "The cat sat on the mat.", "/-", "-/", "-", "/", "·", "é", "　", "<|im_start|>assistant\n", "<|im_end|>", "</s>", "### Response:\n"]


def texts(n, seed, most=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(MARKS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize(
    "op, want",
    [
        (t.strip_header, spec.strip_header),
        (t.is_proof_body, spec.proof_body),
        (t.has_proof_body, spec.has_body),
        (t.strip_markdown, spec.markdown),
        (t.best_fence, spec.fence),
        (t.output_start, spec.after_mark),
        (t.strip_tokens, spec.tokens),
        (t.strip_trailing_fence, spec.trailing_fence),
        (t.strip_think, spec.think),
        (t.strip_comments, spec.comments),
        (t.lean_from_text, spec.from_text),
        (lambda d, x: t.strip_comments(d, x, "strict"), lambda s: spec.comments(s, leak=False)),
    ],
)
def test_random_texts(spark, op, want):
    rows = texts(1500, 7)
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, x string").select("k", t.column(op, "x").alias("got"))
    got = {r["k"]: r["got"] for r in df.collect()}
    wrong = [(x, got[k], want(x)) for k, x in enumerate(rows) if got[k] != want(x)]
    assert not wrong[:3]


def test_extract_random(spark):
    rows = texts(1500, 11, 20)
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, x string").select("k", F.expr(ex.extract(SPARK, "x")).alias("f")).select("k", "f.*")
    got = {r["k"]: (r["strategy"], r["proof"]) for r in df.collect()}
    wrong = [(x, got[k], spec.extract(x)) for k, x in enumerate(rows) if got[k] != spec.extract(x)]
    assert not wrong[:3]


def one(spark, op, *values, **options):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"x{k} string" for k in range(len(values))))
    return df.select(F.expr(op(SPARK, *[f"x{k}" for k in range(len(values))], **options)).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "op, given, want",
    [
        (t.strip_comments, "/- outer /- inner -/ still outer -/ after", " after"),
        (t.strip_comments, "/- well-known -/", "--"),
        (t.strip_comments, "/-- doc -/", "--"),
        (t.strip_comments, "/- a/b -/", "/"),
        (t.strip_think, "<think>a<think>b</think>c", "c"),
        (t.strip_think, "x</think>y<think>z", "x</think>yz"),
        (t.strip_think, "<think>only open", "only open"),
        (t.problem_description, "/-- hi -/", "hi"),
        (t.problem_description, "/-- hi -/\n", "/-- hi -/"),
        (t.problem_description, "/--/", ""),
        (t.byte_decode, "ĠĊč", " \n\r"),
        (t.byte_decode, "âĦ¤", "ℤ"),
        (t.byte_decode, "JosÃ©", "José"),
        (t.byte_decode, "ℕ �\n", "ℕ �\n"),
        (t.byte_decode, "é", "�"),
        (t.byte_decode, "­ń", "­ń"),
        (t.scrub, "[P[PAD]AD]a</s>Ġb", "a b"),
        (t.has_proof_body, "```", False),
        (t.has_proof_body, "rw [h]", True),
        (t.is_proof_body, "S : Type _", True),
        (t.is_proof_body, "#### x", False),
        (t.completion_text, '{"choices":[{"text":"a"}]}', "a"),
        (t.completion_text, '{"choices":[{"text":5}]}', ""),
        (t.completion_text, "no json", ""),
        (t.has_declaration, "  theorem x", True),
        (t.has_declaration, "exact theorem_helper x", False),
        (t.lean_from_text, "/-- d -/\ntheorem f : 1 = 1 := by\n  rfl", "/-- d -/\n  rfl"),
    ],
)
def test_vectors(spark, op, given, want):
    assert one(spark, op, given) == want


def test_byte_table():
    table = t.byte_characters()
    assert sorted(table.values()) == list(range(256)) and len(table) == 256


def test_decode_gate(spark):
    for arch, want in (("raw", " "), ("qwen3", "Ġ"), ("RAW", "Ġ")):
        assert one(spark, t.decode_for, arch, "Ġ") == want


@pytest.mark.parametrize(
    "proof, want",
    [
        ("", ""),
        ("import Init\nlemma l : p := by simp", "import Init\nlemma l : p := by simp"),
        ("lemma l : p := by simp", "open Nat\nlemma l : p := by simp"),
        ("  linarith [h]", "open Nat\nlemma s (h : p) : q := by\n  linarith [h]"),
        ("  exact sorry", ""),
        ("  /- todo /- later -/ -/", ""),
        ("lemma l : p :=by simp", ""),
    ],
)
def test_assemble(spark, proof, want):
    assert one(spark, ex.assemble, "open Nat", "", "lemma s (h : p) : q := by", proof) == want


def test_long_texts(spark):
    """Comments and padding nested deeply and very many of them, in time in proportion to the text."""
    import time

    deep = "a" + "/-" * 3000 + " x " + "-/" * 3000 + "b"
    assert one(spark, t.strip_comments, deep) == "ab" == spec.comments(deep)
    took = []
    for n in (4000, 40000):
        text = "".join(f"/- c{k} -/ d-e/f " for k in range(n))
        began = time.time()
        assert one(spark, t.strip_comments, text) == spec.comments(text)
        took.append(time.time() - began)
    assert took[1] < 40 * max(took[0], 0.3)
    padded = "[PAD]" * 20000 + "x" + "[P" * 30 + "[PAD]" + "AD]" * 30 + "</s>y"
    assert one(spark, t.scrub, padded) == "xy"
    from lodestone.functions.text import byte_characters

    of = {b: c for c, b in byte_characters().items()}
    assert one(spark, t.byte_decode, "".join(of[b] for b in "é中\n\x7f ok".encode()) + "中") == "é中\n\x7f ok中"
