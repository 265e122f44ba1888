import json

import pytest
from pyspark.sql import functions as F

from lodestone.functions.dialect import SPARK
from lodestone.operators import extract, jobs, prompts, registry, results
from lodestone.sources import problems, stores
from lodestone.streaming import generate as g

T = [("a", "test", "", "theorem a : 1 = 1 := by", "import Mathlib", ""), ("b", "valid", "/-- hi -/", "theorem b : 2 = 2 := by", "", "")]
FIELDS = "name string, split string, informal_prefix string, formal_statement string, header string, goal string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def theorems(spark):
    return spark.createDataFrame(T, FIELDS)


def test_sources(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "test.jsonl").write_text('{"name":"a","split":"valid","formal_statement":"s","extra":1}\n\n')
    (raw / "problems.jsonl").write_text('{"name":"b","split":"valid","formal_statement":"s","header":"h"}\n{"name":"c","split":"test","formal_statement":"s"}\n')
    got, warnings = problems.load_all(spark, str(tmp_path))
    assert rows(got.select("name", "split_ord", "header")) == [("a", 0, ""), ("b", 1, "h")] and not warnings
    (raw / "test.jsonl").write_text("{bad\n")
    got, warnings = problems.load_all(spark, str(tmp_path))
    assert rows(got.select("name")) == [("b",)] and len(warnings) == 1
    (raw / "test.jsonl").write_text("")
    assert rows(problems.load_split(spark, str(tmp_path), "test").select("name")) == [("c",)]
    (raw / "x.jsonl").write_text('{"name":null,"split":"x","formal_statement":"s"}\n')
    (raw / "every.jsonl").write_text('{"name":"z","split":"valid","formal_statement":"s"}\n')
    assert rows(problems.load_split(spark, str(tmp_path), "valid", "every.jsonl").select("name")) == [("z",)]
    with pytest.raises(Exception, match="lacks name"):
        problems.load_jsonl(spark, f"{raw}/x.jsonl").collect()


def test_registry(spark):
    m = registry.models(spark)
    assert m.count() == 6 and m.select("name").distinct().count() == 6
    windows = [r[0] for r in m.orderBy("ord").select(F.expr(registry.served_window())).collect()]
    assert windows == [4096, 12192, 36864, 12288, 12192, 1024]
    assert registry.find_model(spark, "none").isEmpty()


def test_jobs(spark, theorems):
    plan = jobs.plan_jobs(theorems, registry.find_model(spark, "kimina-prover-distill-8b"), 3)
    assert plan.count() == 6 and plan.select("prompt").distinct().count() == 2
    r = json.loads(plan.where("name = 'a' and i = 2").first()["request"])
    assert r["seed"] == 44 and r["stop"] == registry.CHAT_STOPS and r["prompt"].startswith("<|im_start|>system\n")
    assert jobs.attempts_grid(theorems, 0).count() == 0
    assert spark.sql(f"select {jobs.seed('4294967295L', '1')}").first()[0] == 0


def test_prompts(spark, theorems):
    got = {f: theorems.where("name = 'b'").select(F.expr(prompts.prompt(SPARK, f))).first()[0] for f in prompts.FORMATS}
    assert "\n# Problem:hi\n# Formal statement:\n```lean4\n/-- hi -/\ntheorem b" in got["kimina"] and got["kimina"].endswith("\n```")
    assert got["goedel_v2_nocot"].endswith(":= by\n  sorry\n```") and "proof plan" in got["goedel_v2"]
    assert got["simple"].endswith(":= by") and "hi" not in got["deepseek_prover"]
    bare = spark.sql("select 'a sorry b sorry c' s, '' h, '' i").select(F.expr(prompts.prompt(SPARK, "deepseek_prover", "h", "i", "s"))).first()[0]
    assert bare.endswith("a sorry b")


def test_keyed_results(spark):
    old = spark.createDataFrame([("t", "attempt_1", "o"), ("t", "attempt_9", "o")], "theorem string, attempt_key string, raw string")
    new = spark.createDataFrame([("t", "attempt_1", "n"), ("u", "attempt_1", "n")], old.schema)
    assert rows(results.upsert(old, new)) == [("t", "attempt_1", "n"), ("t", "attempt_9", "o"), ("u", "attempt_1", "n")]
    both = results.merge_outer(old, new.withColumnRenamed("raw", "lean"))
    assert rows(both) == [("t", "attempt_1", "o", "n"), ("t", "attempt_9", "o", ""), ("u", "attempt_1", "", "n")]
    assert rows(results.complete_groups(old, 2).select("attempt_key")) == [("attempt_1",), ("attempt_9",)]
    assert results.complete_groups(old, 3).isEmpty()


def test_documents(spark, tmp_path):
    found = spark.createDataFrame([("t", f"attempt_{k}", f"r{k}\n\"é", "") for k in (1, 2, 10)], "theorem string, attempt_key string, raw string, lean string")
    doc = results.document(found, "m", "raw").first()[0]
    assert list(json.loads(doc)["m"]["t"]) == ["attempt_1", "attempt_10", "attempt_2"]
    assert set(stores.write_documents(found, str(tmp_path), "org/m x")) == {"raw", "lean"}
    back = stores.read_document(spark, f"{tmp_path}/raw_output/org_m_x", "m")
    assert back.isEmpty() and stores.read_document(spark, f"{tmp_path}/none", "m").isEmpty()
    assert rows(stores.read_document(spark, f"{tmp_path}/raw_output/org_m_x", "org/m x").select("value")) == rows(found.select("raw"))
    with pytest.raises(KeyError):
        stores.read_document(spark, f"{tmp_path}/raw_output/org_m_x", "m", missing="error")
    odd = spark.createDataFrame([('{"m":{"t":{"attempt_1":5,"attempt_2":"x"}}}',)], "document string")
    assert rows(results.unnest(odd, "m")) == [("t", "attempt_2", "x")]
    assert rows(results.unnest(odd, "m", leaves="empty")) == [("t", "attempt_1", ""), ("t", "attempt_2", "x")]


def test_done_set(spark, tmp_path, theorems):
    done = stores.DoneSet(spark, str(tmp_path), "m/x")
    assert done.names().isEmpty() and results.pending(theorems, done.names()).count() == 2
    done.mark(theorems.where("name = 'a'"), 1)
    done.mark(theorems.where("name = 'a'"), 1)
    assert rows(results.pending(theorems, done.names()).select("name")) == [("b",)]
    (tmp_path / "d.json").write_text('["a","a","b"]')
    (tmp_path / "bad.json").write_text("{")
    assert rows(done.read_json(f"{tmp_path}/d.json")) == [("a",), ("b",)] and done.read_json(f"{tmp_path}/bad.json").isEmpty()


def test_re_extract_last_wins(spark):
    twice = spark.createDataFrame([("a", 1, "h1"), ("a", 2, "h2")], "name string, k int, header string")
    assert rows(extract.last_wins(twice, "k").select("header")) == [("h2",)]
    assert rows(extract.recovery(spark.createDataFrame([], "lean string"))) == [(0, 0, 0.0)]
    parts = "name string, header string, informal_prefix string, formal_statement string"
    theorems = spark.createDataFrame([("a", "open X", "", "theorem a : p := by"), ("b", None, None, "theorem b : q := by"), ("a", "open Y", None, "theorem a : r := by")], parts).coalesce(1)
    attempts = spark.createDataFrame([("a", "attempt_1", "```lean4\n  simp\n```"), ("b", "attempt_1", None), ("c", "attempt_1", "x")], "theorem string, attempt_key string, raw string")
    got = extract.re_extract(attempts, theorems).select("theorem", "lean")
    assert rows(got) == [("a", "open Y\ntheorem a : r := by\nsimp"), ("b", "")]


def test_stored_again(spark, tmp_path, theorems):
    """Re-extraction from a stored document keeps the older texts as a backup; status counts done-sets; readiness of a model's folder."""
    out, model = str(tmp_path), "kimina-prover-rl-1.7b"
    with pytest.raises(FileNotFoundError):
        stores.re_extract_file(spark, out, model, theorems)
    found = spark.createDataFrame([("a", "attempt_1", "```lean4\n  simp\n```", "older"), ("a", "attempt_2", "sorry", "older")], "theorem string, attempt_key string, raw string, lean string")
    assert stores.write_documents(found, out, model) == {"raw": 0.0, "lean": 0.0}
    assert rows(stores.re_extract_file(spark, out, model, theorems)) == [(2, 1, 50.0)]
    texts = lambda path: rows(stores.read_document(spark, f"{out}/lean_code/{path}", model, leaves="empty").select("value"))
    assert texts(model + ".bak") == [("older",), ("older",)] and [bool(r[0]) for r in texts(model)] == [False, True]
    stores.re_extract_file(spark, out, model, theorems)
    assert texts(model + ".bak") == texts(model)
    for batch in (1, 2, 1):
        assert stores.write_rows(found.withColumn("raw", F.repeat(F.lit("é"), 100_000)), out, model, batch) == {"raw": 0.4, "lean": 0.0}
    assert spark.read.parquet(f"{out}/results/{model}").count() == 4
    stores.DoneSet(spark, f"{out}/checkpoints", model).mark(theorems, 0)
    counts = dict((r["name"], r["total_done"]) for r in stores.status(spark, f"{out}/checkpoints", registry.models(spark)).collect())
    assert len(counts) == 6 and counts.pop(model) == 2 and set(counts.values()) == {0}
    folder = tmp_path / "m"
    folder.mkdir()
    assert not stores.ready(spark, str(folder)) and not stores.ready(spark, f"{folder}/none")
    (folder / "config.json").write_text("{}")
    assert not stores.ready(spark, str(folder))
    (folder / "x.safetensors").write_text("")
    assert stores.ready(spark, str(folder))


def test_places(spark):
    df = spark.createDataFrame([(k, f"name_{k}") for k in range(30)] + [(30, "name_3"), (31, ""), (32, None)], "k int, name string")
    assert rows(results.skip(df, 5, "k").select("k")) == [(k,) for k in range(5, 33)]
    assert results.skip(df, 40, "k").isEmpty() and results.skip(df, 0, "k").count() == 33 and results.skip(df.limit(0), 3, "k").isEmpty()
    names = sorted({r["name"] for r in df.collect() if r["name"] is not None})
    for lead in (0, 3, 6, 8):
        assert rows(results.numbered(df.dropna(), "name", lead)) == [(x, k + 1) for k, x in enumerate(names)]


def test_without_llm(tmp_path):
    """The entry imports and its own queries run without the subpackage, with and without the pipeline's file."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/lodestone", tmp_path / "lodestone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    say = "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()) and 're_extract' in e.queries() and not any(q.startswith('op') and q[2].isdigit() or q == 'pipeline' for q in e.queries())"
    for extra in ("corpus_pipeline.py", "lodestone/llm/__pycache__"):
        subprocess.run([sys.executable, "-c", say], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
        if extra.endswith(".py") and os.path.exists(f"{root}/{extra}"):
            shutil.copy(f"{root}/{extra}", tmp_path)
        else:
            os.makedirs(tmp_path / extra, exist_ok=True)
    subprocess.run([sys.executable, "-c", say], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_generate(spark, tmp_path, theorems):
    def backend(request):
        import json

        seed = json.loads(request)["seed"]
        if seed == 43:
            raise OSError("down")
        return json.dumps({"choices": [{"text": "```lean4\n  norm_num\n```"}]})

    args = dict(model="kimina-prover-rl-1.7b", backend=backend, out_dir=str(tmp_path), n=2, parallel=2)
    real, g.RETRIES = g.RETRIES, 0
    try:
        got = g.generate(spark, theorems, **args)
    finally:
        g.RETRIES = real
    assert got.count() == 4 and got.where("lean <> ''").count() == 2 and got.where("raw = ''").count() == 2
    assert g.generate(spark, theorems, **args) is None


def test_follow(spark, tmp_path, theorems):
    src = tmp_path / "in"
    src.mkdir()
    row = lambda t, k: json.dumps({"model": "stp-model-lean", "theorem": t, "attempt_key": f"attempt_{k}", "body": json.dumps({"choices": [{"text": "ĠĠrfl"}]})})
    (src / "1.json").write_text(row("a", 1) + "\n" + row("b", 1) + "\n")
    done = stores.DoneSet(spark, f"{tmp_path}/out/checkpoints", "stp-model-lean")

    def go():
        g.follow(spark, str(src), theorems, "stp-model-lean", f"{tmp_path}/out", 2).awaitTermination()

    go()
    assert done.names().isEmpty()
    (src / "2.json").write_text(row("a", 2) + "\n")
    go()
    assert rows(done.names()) == [("a",)]
    got = g.stored_results(spark, f"{tmp_path}/out")
    assert got.count() == 3 and rows(got.select("raw").distinct()) == [("  rfl",)] and got.where("lean <> ''").count() == 3


def test_oracle(spark):
    """Each query and its SQL agree at the smallest size (a few of each kind; the driver runs them all)."""
    import glob
    import os

    import duckdb

    from lodestone.plans import queries as q

    where = "/root/testdata/sf0.001"
    if not os.path.isdir(where):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for f in glob.glob(f"{where}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    assert set(q.ORACLE) == set(q.QUERIES)
    for name in ("models", "strip_header", "re_extract", "jobs", "upsert", "nest"):
        mine = q.QUERIES[name](spark, where)
        columns = sorted(mine.columns)
        other = con.sql(f"SELECT {', '.join(columns)} FROM ({q.ORACLE[name]})").fetchall()
        assert sorted(map(repr, map(tuple, mine.select(*columns).collect()))) == sorted(map(repr, other)), name


def test_whole_texts(spark, tmp_path):
    """The queries read texts to their end, as their SQL does."""
    import duckdb
    import spec

    from lodestone.plans import fixtures
    from lodestone.plans import queries as q

    fence = "```"
    text = lambda k: f"It is {k} words long. " * 40 + f"{fence}lean4\n  norm_num [h{k}]\n{fence}\n<think>b</think> /- c -/ end {k}"
    spark.createDataFrame([(k, text(k)) for k in range(96)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, f"item {k}") for k in range(40)], "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    raw = {(r["theorem"], r["attempt_key"]): r["raw"] for r in fixtures.view(spark, str(tmp_path), "attempts").collect()}
    assert sum(text(k) in x for k, x in enumerate(raw[f"item_{k % 40}", f"attempt_{k // 40 + 1}"] for k in range(96))) == 6 * 6
    for name, op in (("strip_think", spec.think), ("strip_comments", spec.comments), ("best_fence", spec.fence)):
        got = {(r[0], r[1]): r[2] for r in q.QUERIES[name](spark, str(tmp_path)).collect()}
        assert got == {k: op(x) for k, x in raw.items()}
    for name in ("re_extract", "merge_outer", "nest", "output_sizes", "byte_decode"):
        mine = q.QUERIES[name](spark, str(tmp_path))
        columns = sorted(mine.columns)
        other = con.sql(f"SELECT {', '.join(columns)} FROM ({q.ORACLE[name]})").fetchall()
        assert sorted(map(repr, map(tuple, mine.select(*columns).collect()))) == sorted(map(repr, other)), name


def test_whole_ids(spark):
    """upsert and unnest cover all attempts, and the done-set all labels, with theorems left over."""
    import os

    import duckdb

    from lodestone.plans import queries as q

    where = "/root/testdata/sf0.01"
    if not os.path.isdir(where):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{where}/{t}.parquet'")
    n = spark.read.parquet(f"{where}/documents.parquet").count()
    names = spark.read.parquet(f"{where}/benchmark.parquet").count()
    found = {}
    for name in ("upsert", "unnest", "pending", "status", "sorted_names"):
        mine = q.QUERIES[name](spark, where)
        columns = sorted(mine.columns)
        found[name] = sorted(map(repr, map(tuple, mine.select(*columns).collect())))
        other = con.sql(f"SELECT {', '.join(columns)} FROM ({q.ORACLE[name]})").fetchall()
        assert found[name] == sorted(map(repr, other)), name
    assert len(found["upsert"]) == len(found["unnest"]) == n
    done = len(found["sorted_names"])
    assert 0 < done < names and len(found["pending"]) == names - done
