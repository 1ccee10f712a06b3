"""Periodic runs, token counts and whitening against plain re-statements."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from sf_paths import SF_SMALL

from lodestar.llm import periodic_runs as P
from lodestar.llm import token_counts as C
from lodestar.llm import whitening as W

# ------------------------------------------------------------------ op11


def plain_runs(w, least=6, times=4):
    """Every stretch of equal words q apart, by period, without those of a
    smaller period."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q) and \
                    not any(k < q and s <= i and s + n >= i + size for s, n, k in out):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng, most):
    letters, w = rng.choice([1, 2, 3, 5, 30]), []
    while len(w) < rng.randint(0, most):
        if rng.random() < 0.4:
            p = [rng.randint(0, letters) for _ in range(rng.randint(1, 7))]
            w += p * rng.randint(1, 8) + p[:rng.randint(0, len(p))]
        else:
            w.append(rng.randint(0, letters))
    return w


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(1500):
        w = random_words(rng, 80)
        assert P.runs_of(w) == plain_runs(w)


@pytest.mark.parametrize("least,times", [(6, 4), (7, 4), (9, 5), (20, 4)])
def test_stretches_lose_no_run(least, times):
    rng = random.Random(12)
    for _ in range(400):
        docs = [random_words(rng, 60) for _ in range(4)]
        got = P.runs_of_documents([[b"%d" % x for x in w] for w in docs], least, times)
        assert got == [plain_runs(w, least, times) for w in docs]


def test_long_periods_and_long_powers():
    rng = random.Random(13)
    block = [rng.randint(0, 10 ** 6) for _ in range(3000)]
    w = [-1, -2] + block * 4 + block[:7] + [-3] + [5] * 20_000 + [-4]
    words = [b"%d" % x for x in w]
    assert P.runs_of_documents([words])[0] == [(2, 12_007, 3000), (12_010, 20_000, 1)]
    fib = ["a", "ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    assert P.runs_of([ord(c) for c in fib[-1][:2000]], 6, 3) == plain_runs(fib[-1][:2000], 6, 3)


def plain_answer(words):
    runs = plain_runs(words)
    top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    left = " ".join(x for i, x in enumerate(words) if i not in drop)
    said = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256(said.encode()).hexdigest(),
            hashlib.sha256(left.encode()).hexdigest())


def contract_words(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_op11_equals_brute_force_on_short_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    short = docs.filter("n_chars < 2500")
    want = {r.doc_id: plain_answer(contract_words(r.doc_id, r.text)) for r in short.collect()}
    got = P.op11_query(short)
    assert got.columns == ["doc_id", *COLUMNS]
    rows = got.collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == want and len(rows) == len(want)
    assert sum(r.n_runs > 0 for r in rows) > 3


def test_op11_plants_as_the_contract_says(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(40 + i % 50)) + "\t\n") for i in range(300)] +
                                 [(i, t) for i in range(2000, 2100) for t in (" ", None, " x　 y")],
                                 "doc_id long, text string")
    got = docs.select("doc_id", "text", P.planted("doc_id", "text").alias("t")).collect()
    for r in got:
        assert [w.decode() for w in r.t.encode().split()] == contract_words(r.doc_id, r.text)


def test_op11_odd_rows(spark, odd_docs, no_docs):
    rows = P.op11_query(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    empty = hashlib.sha256(b"").hexdigest()
    assert (by[2].n_runs, by[2].start, by[2].runs_sha256, by[2].collapsed_sha256) == (0, None, empty, empty)
    assert (by[4].n_runs, by[4].period) == (1, 1) and by[5].n_runs == 0 and None in by
    assert P.op11_query(no_docs).collect() == []
    whole = P.periodic_runs(odd_docs).filter("doc_id = 4").collect()[0]
    assert [tuple(r) for r in whole.runs] == [(0, 40_000, 1)] and whole.collapsed == "word" and whole.n_words == 40_000
    clash = odd_docs.toDF("doc_id", "text", "n_runs", "start", "runs", "collapsed")
    assert P.op11_query(clash).count() == len(rows)


# ------------------------------------------------------------------ op12

ODD = [" ", "  ", "a", "th", "e", "\n", "\t", "▁", "é", "é", "x\0", "<s>", "</s>", "<unk>", "<0x0A>", "12", "İ",
       "​", "漢字", "🙂", "\r", "))", ";\r", "ﬁ", "　", "the", "ing", "﻿"]


def library(texts):
    return [len(ids) for ids in C.counter(C.MODEL).model.encode(list(texts))]


def test_parts_keep_the_library_counts():
    rng, tool = random.Random(5), C.counter(C.MODEL)
    assert tool.cuts
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for part in (1, 2, 7):
        assert C.count_texts(tool, texts, part, 64) == library(texts)
    assert all("".join(tool.parts(t, 3)) == t for t in texts)


def test_parts_of_texts_without_borders():
    tool = C.counter(C.MODEL)
    texts = ["x" * 50_000, "漢" * 3000, "\n" * 5000, " " * 20_000, "the " * 20_000, ""]
    assert C.count_texts(tool, texts, 100, 1 << 16) == library(texts)
    assert len(list(tool.parts("the " * 20_000, 100))) > 700


def test_op12_equals_the_library(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_docs.select("doc_id", "text"))
    rows = docs.collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()), k, k > 4096)
                  for r, k in zip(rows, library(r.text or "" for r in rows)))
    for spread in (C.SPREAD_BYTES, 3000):  # the second deals out parts of most texts
        got = C.token_counts(docs, part_bytes=500, spread_bytes=spread)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in got.collect()) == want
    assert C.op12_query(no_docs).collect() == []
    clash = odd_docs.toDF("doc_id", "text", "n_tokens", "n_bytes", "part", "digest")
    assert C.op12_query(clash).count() == odd_docs.count()
    assert any(r[3] for r in want)


# ------------------------------------------------------------------ op13


def factor(a):
    r = np.linalg.qr(a, mode="r")
    out = np.zeros((a.shape[1], a.shape[1]))
    out[:len(r)] = r
    return out


def spectra():
    rng = np.random.default_rng(3)
    left = np.linalg.qr(rng.normal(size=(300, 40)))[0]
    right = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    for name, s in {"graded": 10.0 ** -np.arange(40.0), "equal": np.ones(40), "pairs": np.repeat(np.arange(20, 0, -1.0), 2),
                    "close": np.r_[5, 5 - 1e-9, 5 - 2e-9, 4, 4 - 1e-12, 3, 3, 3, 3, np.ones(31)],
                    "gap": np.r_[5, 5 - 1e-4, 5 - 2e-4, 3, 3 - 1e-6, np.ones(35)],
                    "rank": np.r_[3, 2, 1, np.zeros(37)]}.items():
        yield name, left * s @ right
    for d in (1, 2, 3, 9, 70):
        yield f"normal {d}", rng.normal(size=(200, d))
    yield "zero", np.zeros((5, 4))
    yield "diagonal", np.diag(10.0 ** np.arange(12))


@pytest.mark.parametrize("name,a", list(spectra()), ids=lambda x: x if isinstance(x, str) else "")
def test_singular_values_and_directions(name, a):
    r = factor(a)
    diagonal, above, v = W.bidiagonalise(r)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(v.T @ r.T @ r @ v, b.T @ b, atol=1e-12 * max(1, np.square(r).sum()))
    want = np.linalg.svd(a, compute_uv=False) ** 2
    top = max(want[0], 1e-300)
    got = W.dqds(diagonal, above)
    assert len(got) == a.shape[1] and np.abs(got[:len(want)] - want).max() <= 1e-13 * top
    values, rows, total = W.principal(r, 8)
    assert len(values) == min(8, (np.sqrt(want) > 1e-13 * math.sqrt(top)).sum())
    assert abs(total - want.sum()) <= 1e-12 * top
    assert np.abs(rows @ rows.T - np.eye(len(rows))).max(initial=0) < 1e-11
    assert np.abs((a @ rows.T).T @ (a @ rows.T) - np.diag(values)).max(initial=0) < 1e-11 * top


def test_dqds_keeps_small_values():
    a, b = 10.0 ** -np.arange(0, 30, 2.0), 10.0 ** -np.arange(1, 29, 2.0)
    n = len(a)
    got = W.dqds(a, b)
    # by exact fractions: the product of the squares is the product of the diagonal's
    assert abs(sum(math.log(x) for x in got) - 2 * sum(math.log(x) for x in a)) < 1e-12 * n
    assert np.all(got > 0)


def vectors(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 12)) @ np.diag(np.r_[4, 3, 2, np.ones(9)])
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(base)]
    rows += [(300, None, 0), (301, [None] + [1.0] * 11, 0), (302, [float("nan")] * 12, 0),
             (303, [float("inf")] + [0.0] * 11, 0), (304, [1.0, 2.0], 0), (305, [], 0), (306, [0.0] * 12, 0),
             (0, rows[0][1], 0), (None, rows[1][1], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), rows


def test_op13_equals_numpy(spark):
    df, rows = vectors(spark)
    sound = [(i, v) for i, v, _ in rows if v and len(v) == 12 and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in sound], object)
    n, s = len(x), x.sum(0)
    deviation = [int(sum(t * t for t in n * r - s)) for r in x]
    y = (n * x - s).astype(float) / n
    e, vec = np.linalg.eigh(y.T @ y / n)
    e, vec = e[::-1], vec[:, ::-1]
    want = y @ vec[:, :8] / np.sqrt(e[:8])
    got = W.whiten(df.repartition(5)).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.deviation) for r in got if r.component == 1) == \
        sorted((i if i is not None else -1, t) for (i, _), t in zip(sound, deviation))
    for k in range(8):
        mine = sorted((r.deviation, r.whitened) for r in got if r.component == k + 1)
        other = sorted(zip(deviation, want[:, k]))
        a, b = np.array([m[1] for m in mine]), np.array([m[1] for m in other])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert abs(next(r.explained for r in got if r.component == k + 1) - e[k] / e.sum()) < 1e-12
    assert {r.identity_error for r in got}.pop() < 1e-10


def test_op13_few_rows_and_dimensions(spark):
    df, _ = vectors(spark)
    assert W.whiten(df.limit(0)).collect() == []
    assert W.whiten(df.filter("vec_id in (300, 301)")).collect() == []
    assert W.whiten(df.filter("vec_id = 5")).collect() == []  # one vector has no spread
    two = W.whiten(df.filter("vec_id in (5, 6)")).collect()
    assert [(r.component, round(abs(r.whitened), 9)) for r in two] == [(1, 1.0)] * 2
    clash = df.withColumn("x", df.label).withColumn("white", df.label).withColumn("n", df.label)
    assert W.whiten(clash, components=3).filter("component > 3").count() == 0


def test_op13_factors_meet_in_any_number(spark):
    df, _ = vectors(spark)
    wide = df.repartition(70)
    a, b = W.whiten(df.coalesce(1)).collect(), W.whiten(wide).collect()
    value = lambda rows: sorted((r.component, round(abs(r.whitened), 8)) for r in rows)
    assert value(a) == value(b)


def test_exact_beyond_64_bits():
    x = np.array([[2 ** 50, -2 ** 50], [3, 4]], np.int64)
    y = W.centred(x, 10 ** 6, [7, 11])
    assert y.tolist() == [[10 ** 6 * 2 ** 50 - 7, -10 ** 6 * 2 ** 50 - 11], [3 * 10 ** 6 - 7, 4 * 10 ** 6 - 11]]
    assert W.squares(y) == [sum(v * v for v in r) for r in y.tolist()]
