"""Each operator against its brute-force version, with odd rows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute import KINDS, components, leaks, lines, luhn, personal, repeats, sha
from pyspark.sql import functions as F

from lodestone.llm import bpe, chat, decontam, fingerprint, graph, langid, line_dedup, ngram_join, pii, quality, suffix_dedup
from lodestone.llm.queries import BPE_FILE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path(BPE_FILE)


def corpus(seed=1, n=60):
    """Texts with copies, near copies, shared passages, repeated lines and odd rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(120)]
    line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 14)))
    passage = " ".join(rng.choice(vocabulary) for _ in range(80))
    out = []
    for k in range(n):
        kind = k % 6
        if kind == 0 or not out:
            t = "\n".join(line() for _ in range(rng.randint(1, 8)))
        elif kind == 1:
            t = rng.choice(out)
        elif kind in (2, 3):
            w = rng.choice(out).split(" ")
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
            t = " ".join(w)
        elif kind == 4:
            t = line() + " " + passage + "\n" + line()
        else:
            t = line().upper() + "\n\n" + line() * 2
        out.append(t)
    return out


def table(spark, texts, first=0, extra=True):
    rows = [(k + first, t, ["en", "de", None][k % 3], "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df


ODD = [None, "", " ", "\n\n", "x", "é" * 3000, "a " * 4000, "\x00 \x1c", "x"]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, corpus() + ODD).cache()


def pairs_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_line_dedup(spark, docs):
    got = rows(line_dedup.digest(line_dedup.dedup(docs)))
    rows_ = pairs_of(docs)
    want = [(i, n, g, sha(t)) for i, n, g, t in lines([x for x in rows_ if x[1] is not None])] + [(i, 0, 0, sha("")) for i, t in rows_ if t is None]
    assert got == sorted(want, key=repr)
    assert line_dedup.dedup(docs).columns == [*docs.columns, "n_lines", "n_removed"]
    assert line_dedup.dedup(docs.limit(0)).isEmpty()
    clash = docs.limit(5).withColumns({"gone": docs["doc_id"], "n_lines": docs["doc_id"], "token": docs["doc_id"]})
    assert line_dedup.dedup(clash).count() == 5


def test_line_dedup_removed_line_still_removes(spark):
    words = [f"w{k}" for k in range(10)]
    a, b, c = words, words[1:] + ["x"], words[2:] + ["x", "y"]  # a~b, b~c, not a~c
    got = rows(line_dedup.dedup(table(spark, [" ".join(x) for x in (a, b, c)]), 80).select("doc_id", "n_removed"))
    assert got == [(0, 0), (1, 1), (2, 1)]


def test_line_dedup_row_keys(spark):
    """Rows that share an id but not the text keep their own lines; null ids lose and remove lines, too."""
    w = [" ".join(f"{c}{k}" for k in range(10)) for c in "abcdefg"]
    texts = [(None, w[0] + "\nn"), (None, f"{w[1]}\n{w[0]} x"), (3, f"{w[2]}\n{w[3]}"), (5, f"{w[2]} y\n{w[4]}"), (5, f"{w[5]}\n{w[4]} z\nq"), (7, f"{w[6]}\n{w[1]} v\n{w[5]} u")]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    in_order = [(r["doc_id"], r["text"]) for r in d.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()]
    got = rows(line_dedup.digest(line_dedup.dedup(d)))
    want = [(i, n, g, sha(t)) for i, n, g, t in lines(in_order)]
    assert sum(x[2] for x in want) == 5 and got == sorted(want, key=repr)


@pytest.mark.parametrize("n, percent", [(4, 85), (1, 50)])
def test_ngram_join(spark, docs, n, percent):
    want = components(pairs_of(docs), n, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link(docs, n, percent).collect()}
    assert got == want
    assert ngram_join.link(docs.limit(0)).isEmpty()


def test_ngram_join_bridges(spark):
    """Groups that only a pair of later members links are one component."""
    base = [f"w{k}" for k in range(40)]
    texts = []
    for k in range(0, 24, 2):
        texts.append(" ".join(base[k:] + [f"z{j}" for j in range(k)]))
    d = table(spark, texts)
    want = components(pairs_of(d), 1, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link(d, 1, 80).collect()} == want


def test_ngram_join_mixed_sizes(spark):
    """A group is opened for its smaller members, which alone link with a larger set."""
    common = [f"c{k}" for k in range(100)]
    texts = [" ".join(common)] * 30
    for u in range(8):
        rare, often = [f"u{u}x{k}" for k in range(20)], [f"u{u}y{k}" for k in range(67)]
        core = " ".join(rare + often)
        texts += [" ".join(often)] * 30
        # 88 and 98 words, one group; 100 words, of which 87 link with the 88
        texts += [f"{core} u{u}p", f"{core} u{u}p " + " ".join(common[:10]), core + "".join(f" u{u}q{k}" for k in range(13))]
        # more than LEADERS other sets that have the rare words first
        texts += [" ".join(rare + random.Random(100 * u + k).sample(common, 30)) for k in range(ngram_join.LEADERS + 1)]
    d = table(spark, texts)
    want = components(pairs_of(d), 1, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link(d, 1, 85).collect()} == want


def test_ngram_join_ids(spark):
    """Rows of one id are linked, null ids are documents of their own, and columns of other names do no harm."""
    one, two, other = (" ".join(f"{c}{k}" for k in range(30)) for c in "xyz")
    texts = [(8, one), (8, two), (6, one), (7, two + " more"), (None, one + " w"), (None, other), (None, other + " w"), (None, other), (9, None), (8, ""), (8, one)]
    d = spark.createDataFrame([(i, t, 1, 2, "k") for i, t in texts], "doc_id long, text string, n int, row int, key string")
    got = sorted((tuple(r)[0], r["component_id"]) for r in ngram_join.link(d, 4, 85).where("doc_id is not null").collect())
    assert got == [(6, 6), (7, 6), (8, 6), (8, 6), (8, 6), (8, 8), (9, 9)]
    assert rows(ngram_join.link(d, 4, 85).where("doc_id is null").select("n_shingles", "component_id")) == sorted([(28, 6), (27, None), (28, None), (27, None)], key=repr)


@pytest.mark.parametrize("percent", [50, 85, 100])
def test_ngram_join_overlap_bound(percent):
    """A linked pair's prefixes share at least as many tokens as a group must, over all ways to split a union in order."""
    import itertools

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    found = {}
    for size in range(1, 9):
        for owner in itertools.product((1, 2, 3), repeat=size):  # in the set, the member, both
            a, b = [k for k, o in enumerate(owner) if o & 1], [k for k, o in enumerate(owner) if o & 2]
            if a and b and 100 * len(set(a) & set(b)) >= percent * size:
                pre = [x[: len(x) - -(-percent * len(x) // 100) + 1] for x in (a, b)]
                k = (len(a), len(b))
                found[k] = min(found.get(k, 99), len(set(pre[0]) & set(pre[1])))
    d = spark.createDataFrame([(n, m, least) for (n, m), least in found.items()], "n long, m long, least long")
    for low, high in ((0, 0), (1, 0), (0, 2), (3, 3)):
        bound = ngram_join.least_overlap(F.col("n"), F.greatest(F.col("m") - low, F.lit(1)), F.col("m") + high, percent)
        assert d.where(bound > F.col("least")).isEmpty()


@pytest.mark.parametrize("percent", [50, 85, 100])
def test_ngram_join_group_bound(spark, percent):
    """A group with a member that passes the filters of two sets passes its own."""
    numbers = lambda c, top, first=0: spark.range(first, top).select(F.col("id").alias(c))
    sets = numbers("n", 25, 1).join(numbers("i", 6), F.col("i") < F.col("n")).join(numbers("m", 25, 1)).join(numbers("j", 6), F.col("j") < F.col("m"))
    sets = sets.where(ngram_join.may_link(F.col("n"), F.col("i"), F.col("m"), F.col("j"), percent))
    groups = sets.join(numbers("less", 4)).join(numbers("more", 4)).where("less < m")
    low, high = F.col("m") - F.col("less"), F.col("m") + F.col("more")
    bound = ngram_join.may_share(F.col("n"), low, high, ngram_join.at_most(F.col("n"), F.col("m"), percent), percent) & ngram_join.may_begin(F.col("n"), F.col("i"), low, high, F.col("j"), percent)
    assert groups.count() > 0 and groups.where(~bound).isEmpty()


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 30)] + [(50, 40), (41, 50), (7, 7), (41, 50)]
    got = dict(rows(graph.components(spark.createDataFrame(links, "a long, b long"))))
    assert got == {**{k: 0 for k in range(31)}, 40: 40, 41: 40, 50: 40}


def test_fingerprints(spark, docs):
    d = sorted(pairs_of(docs), reverse=True)
    got = {r["doc_id"]: r for r in fingerprint.compare(docs).collect()}
    assert len(got) == len(d)
    for k, (i, t) in enumerate(d):
        t, follow = t or "", d[(k + 1) % len(d)][1] or ""
        half = len(t) // 2
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == sha(t[: len(t) - half] + follow[:half])
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    by_text = {}
    for i, t in d:
        by_text.setdefault(t or "", set()).add(got[i]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprint.compare(docs.limit(0)).isEmpty() and fingerprint.compare(docs.limit(1)).count() == 1


def test_fingerprint_sketches(spark, docs):
    """Every sketch and likeness against hashes made in plain Python; the same SQL for what SQL can express."""
    import base64
    import re

    import duckdb
    import xxhash

    def hashed(words):
        h = 42
        for w in words:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        return h - (1 << 64) if h >> 63 else h

    def sketch(t):
        w = [x for x in re.split(r"[ \t\n\x0B\f\r]+", t) if x]
        n = fingerprint.SHINGLE
        shingles = [w[k : k + n] for k in range(len(w) - n + 1)] if len(w) >= n else [w] if w else []
        return sorted({hashed(s) for s in shingles})[: fingerprint.SKETCH]

    def likeness(a, b):
        if not a and not b:
            return 1.0
        union = sorted({*a, *b})[: fingerprint.SKETCH]
        return len({*union} & {*a} & {*b}) / len(union)

    text = lambda s: base64.b64encode(b"".join((x % (1 << 64)).to_bytes(8, "big") for x in s)).decode()
    d = sorted(pairs_of(docs), reverse=True)
    got = {r["doc_id"]: r for r in fingerprint.compare(docs).collect()}
    for k, (i, t) in enumerate(d):
        t, follow = t or "", d[(k + 1) % len(d)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + follow[:half]
        a, b, c = sketch(t), sketch(edited), sketch(follow)
        assert "".join(got[i]["fingerprint"].split()) == text(a) and "".join(got[i]["edited_fingerprint"].split()) == text(b)
        assert abs(got[i]["near_edited"] - likeness(a, b)) < 1e-12 and abs(got[i]["near_next"] - likeness(a, c)) < 1e-12
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").where("text is null or not contains(text, char(0))").toPandas())
    sql = con.sql("""
        WITH o AS (SELECT doc_id, coalesce(text, '') AS t, lead(coalesce(text, '')) OVER w AS f, first(coalesce(text, '')) OVER (ORDER BY doc_id DESC) AS g FROM documents WINDOW w AS (ORDER BY doc_id DESC))
        SELECT doc_id, length(t), sha256(left(t, length(t) - length(t) // 2) || left(coalesce(f, g), length(t) // 2)) FROM o""").fetchall()
    clean = fingerprint.compare(docs.where("text is null or not contains(text, char(0))"))
    assert rows(clean.select("doc_id", "n_chars", "edited_sha256")) == sorted(sql, key=repr)


def test_fingerprint_odd_rows(spark):
    """Null and repeated ids, and columns of clashing names; ties go by text."""
    d = spark.createDataFrame([(None, "n", 1), (2, "b c", 2), (2, "a", 3), (5, None, 4), (None, "m", 5)], "doc_id long, text string, sketch int")
    got = fingerprint.compare(d).collect()
    follow = {"5": ("", "a"), "2": None}
    assert len(got) == 5 and [r["n_chars"] for r in got if r["doc_id"] == 5] == [0] and follow
    clash = fingerprint.with_next(d.selectExpr("doc_id", "text", "sketch as _bucket", "sketch as _extra", "sketch as _head"), ["text"])
    assert clash.columns == ["doc_id", "text", "_bucket", "_extra", "_head", "next_text"]
    assert [(r["doc_id"], r["text"], r["next_text"], r["_head"]) for r in clash.collect()].sort(key=repr) == [(5, None, "a", 4), (2, "a", "b c", 3), (2, "b c", "m", 2), (None, "m", "n", 5), (None, "n", None, 1)].sort(key=repr)


def test_fingerprint_buckets(spark, docs, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 5)
    got = dict(rows(fingerprint.with_next(docs.select("doc_id", "text"), ["doc_id"]).select("doc_id", "next_doc_id")))
    n = len(got)
    assert got == {k: (k - 1) % n for k in range(n)}


def test_sketches(spark):
    from pyspark.sql import functions as F

    words = [f"w{k}" for k in range(4000)]
    df = spark.createDataFrame([(" ".join(words[:3000]), " ".join(words[1000:]), " ".join(words[1000:3000]))], "a string, b string, c string")
    df = df.select(*[fingerprint.sketch(F.col(x), 256).alias(x) for x in "abc"])
    r = df.select(fingerprint.resemblance(F.col("a"), F.col("b"), 256), fingerprint.containment(F.col("c"), F.col("a"), 256), fingerprint.distinct_count(F.col("a"), 256), fingerprint.distinct_count(fingerprint.merge(F.col("a"), F.col("b"), 256), 256)).first()
    assert abs(r[0] - 0.5) < 0.12 and r[1] > 0.8 and abs(r[2] / 3000 - 1) < 0.2 and abs(r[3] / 4000 - 1) < 0.2


def test_quality(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    good = [" ".join(word() for _ in range(40)) + ".\n" + " ".join(word() for _ in range(30)) for _ in range(150)]
    bad = [" | ".join(word().upper() + "!!" for _ in range(40)) for _ in range(60)]
    d = table(spark, good + bad + ODD)
    labels = spark.createDataFrame([(k, int(k < 150), 0) for k in range(210)] + [(0, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(d, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(d, model).collect()}
    assert len(got) == d.count() and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[k] >= quality.CUT) == (k < 150) for k in range(210)]) > 0.95
    assert quality.learn(d, labels.limit(0)) is None and quality.learn(d.limit(0), labels) is None
    assert {r["score"] for r in quality.score(d, None).collect()} == {0.5}
    long = quality.score(spark.createDataFrame([(k, good[0] * 3000) for k in (None, 1, 1)], "doc_id long, text string"), model).collect()
    assert len({r["score"] for r in long}) == 1 and len(long) == 3 and quality.score(d.limit(0), model).isEmpty()
    with_label = d.withColumn("label", d["doc_id"]).withColumn("score", d["doc_id"])
    assert quality.score(with_label, model).count() == d.count()


def test_quality_fit(spark):
    """Features by a plain loop; the weights are where the loss of the drawn pairs has no slope; the cut lies at the quantile."""
    import pyarrow as pa

    texts = ["Ab cd cd.\nAb cd! é", "", None, "x", "A|B 12\n\nA|B 12", "WORD word, word " * 900]
    x = quality.features(pa.array(texts, pa.string()))
    names = ["lower", "upper", "digit", "space", "line", "stop", "bar", "bang", "symbol", "quote", "high"]
    for row, t in zip(x, texts):
        raw, words, lines = (t or "").encode(), (t or "").split(), [v for v in (t or "").split("\n") if v]
        n, some = max(len(raw), 1), max(len(words), 1)
        share = {name: sum(c in {*quality._CLASSES[name]} for c in raw) / n for name in names}
        share["rest"] = (len(raw) - sum(round(v * n) for v in share.values())) / n
        pairs = list(zip([w.lower() for w in words], [w.lower() for w in words][1:]))
        want = [v**0.5 for v in share.values()] + [np.log1p(len(words)), len({w.lower() for w in words}) / some, 1 - len(set(pairs)) / max(len(pairs), 1)]
        want += [1 - len(set(lines)) / max(len(lines), 1), n / some / 10]
        assert np.allclose(row[: len(want)], want), t
        assert row[-1] == (len(words) < 5) and row[-2] == (not words)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 4))
    label = (x @ [1, -2, 0, 0.5] + rng.normal(size=80) > 0).astype(int)
    model = quality.fit(x, label, pairs=500)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    draw = np.random.default_rng(quality.SEED)
    z = (x - x.mean(0)) / x.std(0)
    d = z[draw.choice(good, 500)] - z[draw.choice(bad, 500)]
    slope = 1e-4 * model["w"] - (d / (1 + np.exp(d @ model["w"]))[:, None]).mean(0)
    assert np.abs(slope).max() < 1e-5
    s = quality.scores(model, x)
    assert abs(np.mean(s < quality.CUT) - len(bad) / 80) <= 1 / 80 and (np.argsort(s) == np.argsort(z @ model["w"])).all()


@pytest.mark.parametrize("chunk", [10**6, 7])
def test_decontamination(spark, docs, chunk):
    d = pairs_of(docs)
    long = d[4][1].replace("\n", " ").split(" ")
    items = [(1, " ".join(long[3:20])), (10, " ".join(long[5:30])), (2, "x"), (3, None), (4, ""), (5, d[0][1]), (5, d[0][1]), (None, "x")]
    b = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontam.digest(decontam.decontaminate(docs, b, chunk=chunk)))
    assert got == sorted(leaks(d, items), key=repr)
    assert decontam.decontaminate(docs.limit(0), b).isEmpty()
    assert not any(r["n_hit"] for r in decontam.digest(decontam.decontaminate(docs, b.limit(0))).collect())


def test_proximity(spark):
    import pyarrow as pa

    d = table(spark, ["a x x b", "a x x x x b", "b a", "a", "b"])
    block = decontam.Block(decontam.build_index(d.coalesce(1)).first().asDict())
    query, _ = decontam.words(pa.array(["a b"]))
    which, at = block.proximity(query.reshape(1, 2), np.array([2]), 3)
    assert {block.doc_ids[k] for k in block.doc(at).tolist()} == {0, 2} and set(which.tolist()) == {0}


@pytest.mark.parametrize("chunk", [10**6, 3])
def test_proximity_matches(spark, chunk):
    """Items whose windows' words all stand near the rarest one, in any order, against a plain search; ids are strings."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None]
    items = [(f"i{k}", " ".join(rng.sample("abcdefgh", rng.randint(1, 4)))) for k in range(12)] + [(None, "a"), ("n", None)]
    d = spark.createDataFrame([(None if k == 7 else f"d{k}", t) for k, t in enumerate(texts)], "doc_id string, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    got = decontam.decontaminate(d, b, chunk=chunk, within=3).collect()
    assert len(got) == len(texts)
    by_id = {r["doc_id"]: r for r in got}
    for k, t in enumerate(texts):
        if k == 7:
            continue
        w, exact, near = (t or "").split(), set(), set()
        for i, x in items:
            x = (x or "").split()
            if not x or i is None:
                continue
            if any(w[j : j + len(x)] == x for j in range(len(w))):
                exact.add(i)
            if all(c in w for c in x):
                span = [j for j, c in enumerate(w)]
                # any posting of the rarest term of the block; for distinct letters the rarest is one of them
                if any(all(any(w[m] == c and abs(m - j) <= 3 for m in span) for c in x) for j in span if w[j] in x):
                    near.add(i)
        r = by_id[f"d{k}"]
        assert set(r["items"]) == exact and set(r["near_items"]).isdisjoint(exact) and set(r["near_items"]) <= near
        assert exact <= near
    assert any(r["near_items"] for r in got)


def test_bpe(spark, docs):
    ranks = bpe.load_ranks(PATH)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(bpe.round_trip(docs, PATH, public_tokenizers.PATTERN))
    want = []
    for i, t in pairs_of(docs):
        ids = plain.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert got == sorted(want, key=repr)
    rng = random.Random(5)
    for leaf in (2, 5, 31):
        coder = bpe.TreeBpe(ranks, public_tokenizers.PATTERN, leaf)
        for k in range(600):
            t = "".join(rng.choice(["a", "B", " ", "  ", "\n", "'s", "é", "中" if k % 2 else "µ", "1", "#", "\x1c", "\xa0", "²", "x "]) for _ in range(rng.randint(0, 60)))
            assert coder.encode(t).tolist() == plain.encode_ordinary(t)
            assert coder.decode(coder.encode(t)) == t.encode()


def test_bpe_long_pieces():
    """Pieces of many leaves, which a text's halves cut, and pieces that begin or end across a boundary."""
    ranks = bpe.load_ranks(PATH)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    long = ["".join(rng.choice(letters) for _ in range(n)) for letters, n in (("aeiounrst", 50000), ("ab", 20000), ("中文字", 9000), ("=-#", 30000), ("0123", 20000), (" ", 5000), ("\n ", 5000), ("a'sre", 20000), ("é", 7000))]
    texts = long + ["".join(rng.sample(long, 4)), "x" + "'re" * 4000, "'" * 3000 + "s" * 3000, " " * 3000 + "word"]
    for leaf in (2, 16, bpe.LEAF):
        coder = bpe.TreeBpe(ranks, public_tokenizers.PATTERN, leaf)
        for t in texts:
            got = coder.encode(t)
            assert got.tolist() == plain.encode_ordinary(t) and coder.decode(got) == t.encode()


def test_bpe_odd_tables(spark):
    d = spark.createDataFrame([(None, "a b", 1), (3, None, 2), (3, "a b", 3), (3, "a b", 4)], "doc_id long, text string, tokens int")
    got = bpe.decode(bpe.encode(d, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "text", "tokens", "decoded"]
    one = bpe.encode(d.withColumn("decoded", F.lit(1)), PATH, public_tokenizers.PATTERN, decoded="decoded")
    assert one.columns == got.columns and rows(one) == rows(got)
    assert rows(got.select("doc_id", "decoded")) == sorted([(None, bytearray(b"a b")), (3, bytearray()), (3, bytearray(b"a b")), (3, bytearray(b"a b"))], key=repr)
    assert bpe.round_trip(d.limit(0), PATH, public_tokenizers.PATTERN).isEmpty()


@pytest.mark.parametrize("length, gram", [(40, 12), (64, 64), (33, 1)])
def test_suffix_dedup(spark, docs, length, gram):
    got = rows(suffix_dedup.digest(suffix_dedup.dedup(docs, length, gram)))
    assert got == sorted(repeats(pairs_of(docs), length), key=repr)


def test_suffix_dedup_planted(spark):
    """The contract's 400 bytes: passages of over 50 words go from that length on, whatever their words."""
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(5)) for _ in range(n))
    passages = [prose(51), prose(80)[:399], prose(80)[:400], prose(80)]  # 305, 399, 400 and 479 bytes
    texts = [f"{prose(40)} {chr(65 + k)}{p}{chr(97 + k)} {prose(30)}" for k, p in enumerate(passages * 2)] + [prose(200)]
    got = {r["doc_id"]: r for r in suffix_dedup.digest(suffix_dedup.dedup(table(spark, texts))).collect()}
    assert [got[k]["n_removed"] for k in range(len(texts))] == [0, 0, 400, 479] * 2 + [0]
    assert sorted(map(tuple, got.values()), key=repr) == sorted(repeats(list(enumerate(texts)), 400), key=repr)


def test_suffix_dedup_odd(spark, docs, monkeypatch):
    few = docs.where("doc_id < 30")
    for group in (700, 3, 100):  # splits buckets by distance, with the least value to windows that stand alone
        monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", group)
        assert rows(suffix_dedup.digest(suffix_dedup.dedup(few, 40, 12))) == sorted(repeats(pairs_of(few), 40), key=repr)
    assert rows(suffix_dedup.digest(suffix_dedup.dedup(few, 40, 12))) == sorted(repeats(pairs_of(few), 40), key=repr)
    assert suffix_dedup.dedup(docs.limit(0)).isEmpty()
    twice = few.unionByName(few.where("doc_id = 4"))
    got = [tuple(r) for r in suffix_dedup.digest(suffix_dedup.dedup(twice, 40, 12)).where("doc_id = 4").collect()]
    assert len(got) == 2 and all(r[1] == r[2] for r in got)
    with pytest.raises(ValueError):
        suffix_dedup.dedup(docs, 10, 4)


def test_suffix_dedup_pieces(spark, monkeypatch):
    """Documents of many pieces, null and repeated ids and clashing columns, end to end."""
    rng = random.Random(11)
    many = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (3000, 900, 200)]
    texts = [many[0] + many[1], many[1][100:700] + many[2], many[2] * 3, many[0][1500:], None, "", many[2]]
    ids = [1, None, 1, 7, None, 3, None]
    d = spark.createDataFrame([(i, t, k, 0, 0) for k, (i, t) in enumerate(zip(ids, texts))], "doc_id long, text string, row int, bucket int, removed int").coalesce(1)
    monkeypatch.setattr(suffix_dedup, "PIECE", 250)
    want = [(ids[i], *x) for i, *x in repeats(list(enumerate(texts)), 40)]
    assert rows(suffix_dedup.digest(suffix_dedup.dedup(d, 40, 12))) == sorted(want, key=repr)


def test_long_documents(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 100)
    rng = random.Random(2)
    raw = np.array([rng.choice(b"ab") for _ in range(1000)], np.uint8)
    whole = suffix_dedup.anchors(raw, np.array([0, 1000]), 40, 12)
    starts = sum((hi - lo + 1) for lo, hi in zip(whole[1], whole[2]))
    assert starts == 961


def test_pii(spark):
    card = next(f"4{k:015d}" for k in range(10**6) if luhn(f"4{k:015d}"))
    texts = [
        None,
        "",
        f"é write to a.b@c.de.fr or a@b.c_x@y.zz, a@b.c.@d.e and @x",
        "10.0.0.1 1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.2.3 1.2.3",
        f"{card} {card[:4]}-{card[4:8]} {card[8:]} 1234567890123456 5 6",
        "+1 (017) 555-7713 +49-30-1234567. +1 23 +123456789012345678",
        'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" end',
        "x" * 50000 + " 1 2" * 3000,
        "9" * 20000,
        "+" + "1 " * 3000,
    ]
    d = table(spark, texts)
    got = {r["doc_id"]: r for r in pii.digest(pii.detect(d)).collect()}
    for k, t in enumerate(texts):
        base = personal(t)
        assert got[k]["base_sha256"] == sha(",".join(base)), t and t[:60]
        assert [got[k][f"n_{x}"] for x in KINDS] == [sum(b.startswith(x) for b in base) for x in KINDS]
        assert set(base) <= set(filter(None, got[k]["spans"].split(",")))
    assert "secret:9:49" in got[6]["spans"] and got[3]["spans"].count("ip") == got[3]["n_ip"]
    assert pii.detect(d.limit(0)).isEmpty()


def test_pii_long_secret(spark):
    """A secret's span has all of a long token."""
    token = "".join(random.Random(3).choice("abcdefXYZ0123456789._-") for _ in range(900))
    text = f"key: api_key = '{token}' and secret: {token[:8]}"
    df = spark.createDataFrame([(text,)], "text string")
    got = df.select(pii.located(F.col("text"), pii.LOOSE["secret"]).alias("x")).first()["x"]
    assert [(m["start"], m["value"]) for m in got] == [(text.index(token), token), (len(text) - 8, token[:8])]


def test_pii_many_matches(spark):
    """Very many matches in one text are found in time in proportion, with the right places."""
    import time

    took = []
    for n in (1500, 12000):
        text = "".join(f"x{k}@mail.example.org, é 10.0.{k % 256}.7; " for k in range(n))
        began = time.time()
        got = pii.digest(pii.detect(table(spark, [text]))).first()
        took.append(time.time() - began)
        assert got["n_email"] == n and got["n_ip"] == n and got["base_sha256"] == sha(",".join(personal(text)))
    assert took[1] < 30 * max(took[0], 0.5)


def test_pii_below(spark):
    d = spark.createDataFrame([([1, 3, 3, 7], x) for x in range(10)] + [([], 4)], "a array<int>, x int")
    assert [tuple(r) for r in d.select("x", pii.below(F.col("a"), F.col("x"))).collect()] == [(x, sum(y < x for y in (1, 3, 3, 7))) for x in range(10)] + [(4, 0)]


def test_em():
    patterns = [(0, "+++0++", True, 50), (0, "-+++++", False, 20), (0, "-----+", False, 100)]
    truth = pii.reliabilities(patterns)
    assert truth[0] == 1 and truth[2] < 0.5 < truth[1]
    p = pii.classifier(patterns, truth)
    assert p["0:-+++++"] > 0.5 > p["0:-----+"] and pii.classifier([], []) == {} and pii.reliabilities([]) == []


def test_chat(spark):
    m = [
        (1, 0, "user", "Hello there.\n\nHow is the weather?"),
        (1, 1, "assistant", "Sunny today."),
        (1, 2, "user", "On Monday X wrote:\n> how is the  weather?\nStill asking."),
        (1, 3, "assistant", "> Still asking.\n> > How is the weather?\nrain"),
        (1, 4, "user", "> Sunny today.\nThanks"),
        (1, 5, "user", "bye"),
        (1, 6, "user", None),
        (1, 7, "user", "> Sunny today.\nagain"),
        (2, 0, "user", "> unknown\nhi"),
        (None, 0, "user", "a"),
        (None, None, "x", "> a\nb"),
    ]
    df = spark.createDataFrame(m, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["position"], r["parent_turn"], r["depth"], r["n_quotes"], r["n_linked"], r["text"]) for r in chat.reply_ordered(df).collect()}
    assert got[1, 2] == (3, 0, 1, 1, 1, "Still asking.")
    assert got[1, 3] == (4, 2, 2, 2, 2, "rain")
    assert got[1, 4] == (5, 1, 2, 1, 1, "Thanks") and got[1, 7][1] == 1
    assert got[1, 6] == (8, 5, 4, 0, 0, "") and got[2, 0] == (1, None, 0, 1, 0, "hi")
    assert got[None, None] == (2, 0, 1, 1, 1, "b")
    assert chat.reply_ordered(df.limit(0)).isEmpty() and chat.reply_ordered(df.unionByName(df)).count() == 22


def test_chat_random(spark):
    """Random threads with quotes of quotes: the SQL written for the checking database, and a plain version of the links."""
    import duckdb

    from lodestone.llm.oracles import QUOTATION_LINKING

    rng = random.Random(21)
    said = [f"Line {k % 9} of {k % 4}, ok?" for k in range(30)]
    m = []
    for conv in [*range(12), None]:
        texts = []
        for turn in range(rng.randint(1, 9)):
            parts = [rng.choice(said) for _ in range(rng.randint(0, 3))]
            if texts and rng.random() < 0.7:
                old = rng.choice(texts).split("\n")
                parts = (["On Monday X wrote:"] if rng.random() < 0.5 else []) + ["> " + v for v in old if v][: rng.randint(1, 4)] + [""] * rng.randint(0, 1) + parts
            texts.append("\n".join(parts))
            m.append((conv, turn if rng.random() < 0.95 else None, rng.choice(["user", "assistant"]), texts[-1] if rng.random() < 0.97 else None))
    df = spark.createDataFrame(m, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash"))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", m)
    got = chat.reply_ordered(df)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({QUOTATION_LINKING})").fetchall()
    assert rows(got) == sorted(want, key=repr) and sum(r["n_linked"] for r in got.collect()) > 20
    long = spark.createDataFrame([(1, 0, "u", "start\n" + "word " * 200000), (1, 1, "u", "> start\n" * 3000 + "end")], "conv_id long, turn long, role string, text string")
    assert [(r["n_quotes"], r["n_linked"], len(r["text"])) for r in chat.reply_ordered(long).orderBy("position").collect()] == [(0, 0, 6 + 1000000), (1, 0, 3)]


def test_sql(spark):
    """The SQL of operators 1, 2, 5 and 9 on the smallest tables."""
    import glob
    import os

    import duckdb

    from lodestone.llm.queries import ORACLE, QUERIES

    where = "/root/testdata/sf0.001"
    if not os.path.isdir(where):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for f in glob.glob(f"{where}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    for name, sql in ORACLE.items():
        mine = QUERIES[name](spark, where)
        columns = sorted(mine.columns)
        assert rows(mine.select(*columns)) == sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall(), key=repr), name


def test_deep_replies(spark):
    """Each message quotes the one before the last, so that every one begins a run."""
    m = [(1, k, "u", (f"> line {k - 2}\n" if k > 1 else "") + f"line {k}") for k in range(40)]
    got = {r["turn"]: r["depth"] for r in chat.reply_ordered(spark.createDataFrame(m, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {k: (0 if k == 0 else 1 if k in (1, 2) else got[k - 2] + 1) for k in range(40)}


def test_language(spark):
    rng = random.Random(8)
    letters = {"aa": "abcdefg", "bb": "cdefghij", "cc": "ghijklméß"}
    text = lambda lang: " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(rng.randint(3, 60)))
    made = [(k, lang, text(lang)) for k, lang in enumerate(rng.choice(list(letters)) for _ in range(300))]
    d = spark.createDataFrame([(k, t, lang if k % 7 else None) for k, lang, t in made] + [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !", None), (1003, "Ж", None)], "doc_id long, text string, lang string")
    samples = langid.learn(langid.training_rows(d))
    assert sorted(samples) == ["aa", "bb", "cc"]
    whole = {lang: {t for _, own, t in made if own == lang} for lang in samples}
    assert all(any(s.startswith(t) for t in whole[lang]) and any(s.endswith(t) for t in whole[lang]) for lang, s in samples.items())
    assert langid.learn(langid.training_rows(d), longest=1) == {lang: min((t for k, own, t in made if own == lang and k % 7 and zlib.crc32(str(k).encode()) % 3 != 1), key=lambda t: (len(t), t)) for lang in samples}
    got = {r["doc_id"]: r for r in langid.identify(d, samples).collect()}
    assert np.mean([got[k]["lang_pred"] == lang for k, lang, _ in made]) > 0.97
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (1000, 1001, 1002))
    assert got[1003]["lang_pred"] in samples and all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in langid.identify(d, {}).collect()} == {"und"}
    assert langid.learn(langid.training_rows(d.limit(0))) == {}


def test_language_by_hand(spark):
    """Predictions and scores from phrases that a plain search counts; long texts, clashing columns and an empty table."""
    rng = random.Random(18)
    samples = {lang: " ".join("".join(rng.choice(a) for _ in range(4)) for _ in range(30)) for lang, a in (("x", "abcd"), ("y", "cdef"), ("z", "aceg"))}
    texts = [" ".join("".join(rng.choice(rng.choice(["abcd", "cdef", "aceg"])) for _ in range(3)) for _ in range(rng.randint(1, 30))) for _ in range(40)] + ["abcd " * 6000, "1 2", None, ""]
    d = spark.createDataFrame([(k % 5 or None, t, "s", 0.5) for k, t in enumerate(texts)], "doc_id long, text string, lang_pred string, score double").withColumn("k", F.monotonically_increasing_id())
    got = langid.identify(d, samples)
    assert got.columns == ["doc_id", "text", "k", "lang_pred", "score"]

    def phrases(t, sample):
        n = at = 0
        while at < len(t):
            k = 1
            while at + k < len(t) and t[at : at + k + 1] in sample:
                k += 1
            at, n = at + k, n + 1
        return n

    for r in got.collect():
        t = "".join(map(chr, langid.normal([r["text"] or ""])[0].tolist()))
        if not t.strip():
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cost = {lang: max(phrases(t, s), 1) * np.log2(len(s) + 2) for lang, s in samples.items()}
        best = min(cost, key=lambda x: (cost[x], x))
        assert r["lang_pred"] == best and abs(r["score"] - (1 / cost[best]) / sum(1 / c for c in cost.values())) < 1e-9
    assert langid.identify(d.limit(0), samples).isEmpty()


@pytest.mark.parametrize("stretch", [2, 7, 256])
def test_cross_parse(monkeypatch, stretch):
    """Phrases are greedy longest matches of whole texts, by a plain search."""
    monkeypatch.setattr(langid, "STRETCH", stretch)
    rng = random.Random(3)
    sample = "".join(rng.choice("ab ") for _ in range(200))
    parser = langid.CrossParser({"x": sample})
    codes, _ = langid.normal([sample])
    plain = "".join(map(chr, codes.tolist()))
    texts = ["".join(rng.choice("abcc ") for _ in range(rng.randint(1, 100))) for _ in range(50)]
    texts += ["".join(rng.choice("aabb ") for _ in range(900)), sample, sample * 3, sample[20:150] + "c" + sample[30:90], ""]
    got, _ = parser.phrases(texts)
    for t, n in zip(texts, got[:, 0]):
        codes, _ = langid.normal([t])
        t, at, count = "".join(map(chr, codes.tolist())), 0, 0
        while at < len(t):
            k = 1
            while at + k < len(t) and t[at : at + k + 1] in plain:
                k += 1
            at, count = at + k, count + 1
        assert count == n


def test_pipeline(spark, tmp_path):
    """run() against the brute-force versions in a row."""
    import corpus_pipeline

    texts = corpus(9, 48) + [None, "", "12"]
    d = table(spark, texts)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    item = " ".join(texts[0].replace("\n", " ").split(" ")[:12])
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [(k, t) for k, t in enumerate(texts) if t and any(c.isalpha() for c in t)]
    left = [(i, t) for i, n, g, t in lines(left) if not g or (g < n and t.strip())]
    found = components(left, 5, 80)
    left = [(i, t) for i, t in left if found[i][1] == i]
    left = [(i, t) for (i, t), r in zip(left, leaks(left, [(0, item)])) if not r[5]]
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})
    want = [(i, len(ids := plain.encode_ordinary(t)), sha(",".join(map(str, ids))), sha(t)) for i, t in left]
    assert rows(corpus_pipeline.run(spark, str(tmp_path))) == sorted(want, key=repr)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, d.limit(0), str(tmp_path)).columns == corpus_pipeline.COLUMNS, name


def test_pipeline_odd_rows(spark, tmp_path):
    """Rows that share an id, null ids, repeated rows and clashing columns: no clean text goes."""
    import corpus_pipeline

    one, two, three, four = (" ".join(f"{c}{k}" for k in range(30)) for c in ("ab", "cd", "ef", "gh"))
    texts = [(7, one), (7, two), (3, one + " x"), (None, three), (None, three + " y"), (None, four), (None, two + " z"), (9, one), (9, one), (4, "leak " + " ".join(f"q{k}" for k in range(12))), (4, "clean words stay here, all of them")]
    d = spark.createDataFrame([(i, t, "en", "s", len(t), 1, 2) for i, t in texts], SCHEMA + ", key int, n_lines int")
    spark.createDataFrame([(0, " ".join(f"q{k}" for k in range(12)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = corpus_pipeline.join_near(spark, d, "")
    assert near.columns == corpus_pipeline.COLUMNS
    kept = sorted(((r["doc_id"], r["text"]) for r in near.collect()), key=repr)
    assert [x for x in kept if x[0] is not None] == [x for x in sorted(texts, key=repr) if x[0] == 3 or x == (7, two) or x[0] == 4]
    assert len([x for x in kept if x[0] is None and x[1].startswith("ef")]) == 1 and (None, four) in kept and len(kept) == 6
    left = corpus_pipeline.drop_leaks(spark, d, str(tmp_path))
    assert rows(left.select("doc_id", "text")) == sorted((x for x in texts if not (x[1] or "").startswith("leak")), key=repr)
    changed = corpus_pipeline.dedup_lines(spark, d, "")
    assert changed.columns == corpus_pipeline.COLUMNS and changed.where("doc_id = 4").count() == 2


def test_quality_all_rows(spark):
    """The fit has no slope on the pairs of all rows, whatever their number, and the cut leaves as many rows below as label 0 has."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 5)) * [1, 2, 0.1, 1, 30] + [0, 5, 0, 1, 0]
    label = (x @ [1, -0.5, 0, 0.5, 0.02] + rng.normal(size=900) > -1).astype(int)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    z = (x - x.mean(0)) / x.std(0)
    d = (z[good][:, None] - z[bad][None]).reshape(-1, 5)
    rows = spark.createDataFrame([(int(k), bytearray(v.tobytes())) for k, v in zip(label, x)], "label int, x binary")
    for model in (quality.fit(x, label), quality.fitted(quality.added_up(rows.repartition(7)), 1e-4, 60)):
        slope = 1e-4 * model["w"] - (d / (1 + np.exp(d @ model["w"]))[:, None]).mean(0)
        assert np.abs(slope).max() < 1e-4
        assert (quality.scores(model, x) < quality.CUT).sum() == len(bad)
    # more labelled rows than the 30,000 that were learnt from before: none is left out
    many = spark.range(45_000).select("id", (F.col("id") % 3 > 0).cast("int").alias("quality"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("some good words "), "id")).otherwise(F.concat(F.lit("BAD!! "), "id")).alias("text"))
    many = many.withColumnRenamed("id", "doc_id")
    seen = []
    kept, quality.fitted = quality.fitted, lambda tally, *_: seen.append(tally(lambda x, label: np.array([len(x), label.sum()])))
    try:
        quality.learn(many.select("doc_id", "text"), many.select("doc_id", "quality"))
    finally:
        quality.fitted = kept
    own = many.where(~quality.held_out())
    assert seen[0].tolist() == [own.count(), own.where("quality = 1").count()] and seen[0][0] > 35_000


def test_common_words_meet_no_group(spark, monkeypatch):
    """Long sets that share most words but too few for a link: the join of tokens and groups makes no row for each pair of them."""
    common = " ".join(f"c{k}" for k in range(900))
    texts = [" ".join(f"w{i}x{k}" for k in range(100)) + " " + common for i in range(24)]
    d = table(spark, [*texts, texts[0] + " end"])
    made = {}
    real = ngram_join.written

    def counted(df, name):
        out = real(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link(d).collect()}
    assert got == {k: k % 24 for k in range(25)}
    assert made["met"] <= 24  # 23 * 24 / 2 pairs share about 50 tokens of their prefixes


def test_alike_keeps_linked_sets(spark):
    """Whole parities leave out only sets that link with no member of the group."""
    import pyarrow as pa

    rng = random.Random(11)
    base = [[f"b{i}w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 700, 2500]))] for i in range(12)]
    texts = []
    for words in base:
        for edits in (0, 1, len(words) // 60, len(words) // 40):
            new = list(words)
            for k in rng.sample(range(len(new)), edits):
                new[k] = "new" + str(rng.randrange(10**6))
            texts.append(" ".join(new))
    made = ngram_join.shingle_sets(pa.array(texts), 4)
    sets = spark.createDataFrame([(k, len(x), bytearray(ngram_join.parity(x))) for k, x in enumerate(made)], "key long, n long, parity binary")
    groups = spark.createDataFrame([(k, k - k % 4) for k in range(24)], "node long, component long")  # the others are groups of their own
    pairs = [(a, b) for a in range(48) for b in range(48) if b >= 24 or b % 4 == 0]
    kept = {tuple(r) for r in ngram_join.alike(spark.createDataFrame([(a, b, len(made[a])) for a, b in pairs], "key long, group long, n long"), sets, groups, 85).collect()}
    for a, b in pairs:
        members = range(b, b + 4) if b < 24 else [b]
        shared = [len({*made[a].tolist()} & {*made[m].tolist()}) for m in members]
        if any(100 * c >= 85 * (len(made[a]) + len(made[m]) - c) for c, m in zip(shared, members)):
            assert (a, b) in kept
    assert len(kept) < len(pairs) / 4


def test_order_key_is_a_bijection(spark):
    """Words of one line keep their number and come rare ones first, by the counts of their counters."""
    d = spark.createDataFrame([("a a  b c",), ("a b",), ("a x y z a",)], "text string")
    rank = line_dedup.ranks(d)
    got = [r["k"] for r in d.select(line_dedup.words_of(F.col("text"), rank).alias("k")).collect()]
    assert [len(k) for k in got] == [3, 2, 4] and all(k == sorted(k) for k in got)
    a = {got[0][-1], got[1][-1], got[2][-1]}
    assert len(a) == 1 and len({*got[0], *got[1], *got[2]}) == 6
    # an argument used twice is made twice: the words are hashed once, and the empty word to leave it out
    plan = d.select(line_dedup.words_of(F.col("text"), F.array(F.lit(0).cast("long"))).alias("k"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("xxhash64(") == 2
