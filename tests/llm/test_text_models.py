"""Language model, language identification, toxicity."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import brown_lm, langid, toxicity

SMALL = "/root/testdata/sf0.001"


def test_brown_scores_against_plain_counts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in brown_lm.op1_query(docs).collect()}
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in texts}
    c = Counter(w for d, t in texts.items() if not held[d] for w in brown_lm.words_of(t))
    n, v = sum(c.values()), len(c)
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        words = brown_lm.words_of(t)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words), sum(c[w] > 0 for w in words), n, held[d])
        assert r.base_score == pytest.approx(base, rel=1e-9)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_brown_rare_words_by_join_equal_looked_up(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    a, b = (brown_lm.score(docs, docs, looked_up=n, clustered=200, classes=8, sweeps=2).orderBy("doc_id").toPandas()
            for n in (1_000_000, 300))
    assert np.allclose(a.base_score, b.base_score) and np.allclose(a.score, b.score) and (a.n_known == b.n_known).all()


def test_brown_model_is_a_distribution(spark):
    train = spark.createDataFrame([(1, "a b a b c d"), (2, "b a b a"), (3, "c d c 7")], "doc_id long, text string")
    known = ["a", "b", "c", "d", "7"]
    # after one word: every known word, the end, and one unknown word of each shape
    tries = [(i, w) for i, w in enumerate(known)] + [(99, "")]
    rows = brown_lm.score(spark.createDataFrame(tries, "doc_id long, text string"), train, classes=2, sweeps=3,
                          looked_up=10**6).toPandas()
    first = 10 ** rows.score  # P(word) P(end | word), and P(end)
    assert 0 < first.sum() < 1


def test_brown_odd_and_empty(spark, odd_docs, no_docs):
    got = brown_lm.score(odd_docs, odd_docs).collect()
    assert len(got) == 9 and sorted(r.n_tokens for r in got)[:2] == [1, 1]
    assert brown_lm.score(no_docs, no_docs).count() == 0
    alone = brown_lm.score(odd_docs, no_docs).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in alone)


def test_exchange_raises_the_likelihood(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    none, some = (brown_lm.score(docs, docs, classes=32, sweeps=n).agg(F.sum("score")).first()[0] for n in (0, 5))
    assert some > none * 0.99


def test_langid_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op9_query(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) <= 2


def _kneser_ney(words, order, discount, alphabet):
    """Plain interpolated Kneser-Ney: P(c | context) as a function."""
    raw, before = Counter(), {}
    for w, n in words.items():
        t = f" {w} "
        for i in range(1, len(t)):
            for k in range(1, order + 1):
                if i - k + 1 < 0:
                    continue
                g = t[i - k + 1:i + 1]
                if k == order or i - k + 1 == 0:
                    raw[g] += n
                else:
                    before.setdefault(g, set()).add(t[i - k])
    count = Counter(raw)
    for g, x in before.items():
        count[g] += len(x)

    def p(ctx, c):
        low = p(ctx[1:], c) if ctx else 1.0 / alphabet
        mine = {g: n for g, n in count.items() if len(g) == len(ctx) + 1 and g[:-1] == ctx}
        total = sum(mine.values())
        if not total:
            return low
        return max(mine.get(ctx + c, 0) - discount, 0) / total + discount * len(mine) / total * low
    return p


def test_langid_matches_brute_force_kneser_ney():
    counts = {"x": {"ab": 3, "abc": 1, "ba": 2}, "y": {"cc": 4, "ca": 1}}
    m = langid.CharModels(counts, order=3, discount=0.75)
    for lang, words in counts.items():
        p = _kneser_ney(words, 3, 0.75, math.exp(-m.floor))
        for w in ("ab", "cc", "abc", "bc", "z"):
            t = f" {w} "
            want = sum(math.log(p(t[max(0, i - 2):i], t[i])) for i in range(1, len(t)))
            assert m.word_scores([w])[0][0, m.langs.index(lang)] == pytest.approx(want, rel=1e-6), (lang, w)


def test_langid_rejects_and_odd(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.learn(docs)
    rows = spark.createDataFrame([(1, "xqzjk wvvkq zzxqj kkwqz jjxzq qqqxz"), (2, None), (3, "12 34"), (4, "the cat and the hat")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(rows, model).collect()}
    assert got[1].rejected and got[2].lang_pred == got[3].lang_pred == "und" and got[2].score == 0.0
    assert langid.identify(odd_docs, model, keep=("doc_id", "score", "t")).drop("score").count() == 9
    assert langid.identify(no_docs, langid.learn(no_docs)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd_docs, langid.learn(no_docs)).collect()} == {"und"}


@pytest.fixture(scope="module")
def toxic_model(spark):
    d = "/root/testdata/sf0.01"
    return toxicity.learn(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))


@pytest.mark.parametrize("text, word", [("you 1d10t", "idiot"), ("s t u p i d", "stupid"), ("m.o.r.o.n", "moron"),
                                        ("l0$er", "loser"), ("idiooooot", "idiot"), ("p@th3t1c!!!", "pathetic"), ("5tup1d", "stupid")])
def test_toxic_restores(toxic_model, text, word):
    assert word in toxic_model.restorer.text(text).split()
    if word in toxic_model.weights:
        assert toxic_model.score(text) >= 0.7


def test_toxic_leaves_clean_text(toxic_model):
    for text in ("the cat sat on the mat", "a a a a a a a", "", "1 2 3", "###"):
        assert toxic_model.score(text) < 0.7


def test_pruned_scores_equal_full_decoding(spark, toxic_model):
    import re
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect():
        full = {w for t in set(r.text.lower().split()) for w in re.findall(r"[^\W\d_]+", toxic_model.restorer.token(t))
                if w in toxic_model.weights}
        assert full <= toxic_model.marks(r.text)


def test_viterbi_equals_all_readings():
    import itertools
    m = toxicity.CharModel({"ace": 5, "aces": 3, "cat": 4, "sea": 2})
    for text in ("@c3", "c4t", "5e@", "a-c3"):
        def value(ways):
            out, at = "", 0.0
            for read, cost in ways:
                at -= cost
                if read:
                    at += m.logp((" " + out)[-4:], read)
                    out += read
            return at + m.logp((" " + out)[-4:], " "), out
        best = max(value(w) for w in itertools.product(*toxicity.readings(text)))
        assert toxicity.decode(text, m) == best[1]


def test_long_token_search_equals_pattern():
    import random
    words, rng = ["bad", "oxo", "sass"], random.Random(3)
    pattern, linear = toxicity.spelling(words), toxicity.Spelled(words)
    for _ in range(3000):
        token = "".join(rng.choice("bados54@0*x._!1") for _ in range(rng.randint(0, 9)))
        assert linear.search(token) == bool(pattern.search(token)), token
    assert not toxicity.Spelled([]).search("abc")
    assert not linear.search("x" * 100_000) and linear.search("x" * 100_000 + "b-a.d")


def test_long_spaced_runs_end(toxic_model):
    import random
    import time
    rng, start = random.Random(5), time.monotonic()
    assert toxic_model.marks(" ".join(rng.choice("0123456789") for _ in range(100_000))) == set()
    assert toxic_model.marks("1 0 " * 50_000) == set()
    assert time.monotonic() - start < 60


def test_decode_goes_on_over_piece_borders(toxic_model, monkeypatch):
    import random
    model, rng = toxic_model.restorer.model, random.Random(7)
    for border in (256, 512):
        for at in range(border - 14, border + 4, 2):
            assert "idiot" in toxic_model.restorer.text("z " * (at // 2) + "i d i o t" + " z" * 200), at
    texts = ["".join(rng.choice("idots10.* @") for _ in range(60)) for _ in range(20)]
    monkeypatch.setattr(toxicity, "PIECE", 1 << 30)
    whole = [toxicity.decode(t, model) for t in texts]
    for size in (1, 7, 16):
        monkeypatch.setattr(toxicity, "PIECE", size)
        assert [toxicity.decode(t, model) for t in texts] == whole


@pytest.mark.parametrize("text", ["you are an i d i o t.", "i d i o t, ok", '"i d i o t" he', "an (i d i o t)!", "_i d i o t_",
                                  "i  d  i  o  t", "i\td\ti\to\tt", "i d\n\ni\r\no t", "i\u00a0d\u00a0i\u00a0o\u00a0t", "i, d, i, o, t"])
def test_spaced_words_beside_marks_and_any_white_space(toxic_model, text):
    assert "idiot" in toxic_model.restorer.text(text).split()
    assert "idiot" in toxic_model.marks(text)


@pytest.mark.parametrize("text", ["idiot/moron", "idiot.You", "an-idiot", "<b>idiot</b>", "you,idiot", "idiot...moron", "idiot_no",
                                  "1d10t/you", "an-1d10t", "you.1d10t.you"])
def test_words_joined_by_marks(toxic_model, text):
    assert "idiot" in toxic_model.marks(text)


def test_mark_as_border_leaves_spelled_words(toxic_model):
    for text, word in (("m.o.r.o.n", "moron"), ("l-o-s-e-r", "loser"), ("st.upid", "stupid"), ("i*d*i*o*t", "idiot"), ("p@th3t1c!!!", "pathetic")):
        assert toxic_model.restorer.text(text).split() == [word]


def test_long_runs_of_marks_end(toxic_model):
    for text in ("-" * 100_000, "- " * 50_000 + "ab", ". -" * 30_000, "a" + " " * 100_000 + "bc", "_." * 50_000 + "ab"):
        assert toxic_model.marks(text) == set()


def test_toxic_odd_and_empty(spark, odd_docs, no_docs, toxic_model):
    assert toxicity.score(odd_docs, toxic_model, keep=("doc_id", "keep"), restored=False).count() == 9
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    empty = toxicity.learn(no_docs, labels)
    assert {r.predicted for r in toxicity.score(odd_docs, empty).collect()} == {0}
    assert toxicity.score(no_docs, empty).count() == 0
