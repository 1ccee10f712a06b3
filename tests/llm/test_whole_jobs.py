"""Operators do the whole of their named work."""

import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import brown_lm, chat_format, decontam, license_scan, toxicity


def test_chat_digest_reads_expanded_examples(spark):
    turns = spark.createDataFrame([(c, t, ("user", "assistant")[t % 2], f"text {t} " * c) for c in range(4) for t in range(c * 3)],
                                  "conv_id long, turn long, role string, text string")
    stored = chat_format.format_turns(turns)
    want = {r.conv_id: (r.n, r.size) for r in chat_format.expand(stored).groupBy("conv_id").agg(
        F.count("*").alias("n"), F.sum(F.length("context")).alias("size")).collect()}
    got = {r.conv_id: (r.n_examples, r.context_chars) for r in chat_format.read_digest(stored).collect()}
    assert got == want and sum(n for n, _ in got.values()) == 8
    off = stored.withColumn("context_end", F.col("context_end") - 1)
    with pytest.raises(Exception, match="context does not end"):
        chat_format.read_digest(off).collect()


def test_long_contexts_go_by_place():
    import pyarrow as pa
    text = "<|im_start|>assistant\nab<|im_end|>\n"
    rows = [{"conv_id": 1, "seq": i + 1, "formatted": text, "start": i * len(text), "is_example": True,
             "context_end": i * len(text) + 22, "target_start": i * len(text) + 22, "target_end": i * len(text) + 24} for i in range(5)]
    got = [e for _, e in chat_format._examples([pa.RecordBatch.from_pylist(rows)], most=len(text))]
    assert [e[1:] for e in got] == [(i * len(text) + 22, "ab") for i in range(5)]
    assert [None if e[0] is None else len(e[0]) for e in got] == [22, len(text) + 22, None, None, None]


def test_long_contexts_are_written_out_and_read(spark, monkeypatch):
    """However long a context is, its example is written in full, and the digest reads it there."""
    turns = spark.createDataFrame([(c, t, ("user", "assistant")[t % 2], f"é<|im_end|>\U0001f600 {t} " * 9) for c in (1, 2, None)
                                   for t in range(24)], "conv_id long, turn long, role string, text string")
    stored = chat_format.format_turns(turns)
    want = sorted(map(tuple, chat_format.read_digest(stored).collect()), key=str)
    monkeypatch.setattr(chat_format, "CONTEXT_CHARS", 500)
    assert sorted(map(tuple, chat_format.read_digest(stored).collect()), key=str) == want
    assert chat_format.read_digest(stored)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 2
    by, texts = {}, {}
    for r in sorted(chat_format.expand(stored).collect(), key=lambda r: r.part):
        context, target = by.get((r.conv_id, r.seq), ("", None))
        assert target is None and len(r.context) <= 500
        by[r.conv_id, r.seq] = context + r.context, r.target
    for r in sorted(stored.collect(), key=lambda r: r.seq):
        before = texts.get(r.conv_id, "")
        texts[r.conv_id] = before + r.formatted
        if r.is_example:
            a, b = (x - r.start for x in (r.target_start, r.target_end))
            assert by.pop((r.conv_id, r.seq)) == (before + r.formatted[:a], r.formatted[a:b])
    assert not by and max(map(len, texts.values())) > 8 * 500


def test_licenses_are_ranked_by_compression():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    for name in ("MIT text", "GPL-3.0 header", "BSD", "MPL-2.0"):
        block = [w.lower() for w in license_scan._WORDS("some words before " + license_scan.TEMPLATES[name] + " and after")]
        assert scanner._ranked(block)[0] == name
    for name in ("CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-4.0"):
        assert [x[1] for x in scanner.text("Text. " + license_scan.TEMPLATES[name] + " More.")] == [name]


def test_toxicity_learns_from_all_labelled_rows(spark):
    """More rows than any bound on them: each enters the counts."""
    docs = spark.range(61_000).selectExpr("id AS doc_id", "concat('plain ', if(id < 6, 'scum ', ''), 'row ', id, ' ', id * 7) AS text")
    labels = docs.selectExpr("doc_id", "if(doc_id < 6 OR doc_id = 60999, 1, 0) AS toxic")
    model = toxicity.learn(docs, labels)
    assert model.weights == {"scum": 6.5 / 7} and model.base == 1.5 / (61_000 - 6 + 1)


def test_toxicity_learns_from_all_words(spark):
    """The language model counts every word, also those of near copies; the lexicon is no bound on it."""
    common = " ".join(f"shared{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    ends = [f"end{chr(97 + i)}{chr(122 - i)}" for i in range(20)]
    docs = spark.createDataFrame([(i, f"{common} {w}") for i, w in enumerate(ends)] + [(99, "other words 4here")], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id = 99 AS INT) AS toxic")
    assert set(ends) <= toxicity.learn(docs, labels).words.keys()
    model = toxicity.learn(docs, labels, lexicon=1)
    assert len(model.words) == 1
    # the shared words stand in several groups of near copies if the ends have the smallest hash
    groups = {r.w: r.n for r in toxicity._labelled_words(docs.selectExpr("CAST(doc_id = 99 AS INT) AS toxic", "encode(text, 'utf-8') AS t"))
              .select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    want, got = toxicity.CharModel(groups), model.restorer.model
    assert len(groups) == 60 + 20 + 3
    for w in groups:
        text = f" {w} "
        for i in range(1, len(text)):
            assert got.logp(text[:i], text[i]) == want.logp(text[:i], text[i])
            assert got.step(text[:i][-4:], text[i]) == want.step(text[:i][-4:], text[i])
    assert got.logp(" zq", "x") == want.logp(" zq", "x") and "zqx" not in got.count and got.total[""] == want.total[""]


def test_brown_may_cluster_every_word(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(brown_lm, "CLUSTERED", 3)
    real = brown_lm.exchange
    monkeypatch.setattr(brown_lm, "exchange", lambda near, n, *a: seen.append(n) or real(near, n, *a))
    train = spark.createDataFrame([(1, "a b a b c d e f g"), (2, "b a b a")], "doc_id long, text string")
    brown_lm.score(train, train, classes=2, sweeps=1, clustered=10**6, looked_up=2).count()
    assert seen == [8]


def test_brown_classes_of_all_words_score_the_texts(spark, monkeypatch):
    """No training word is left to the class of its shape, and a text's score is that of the learned classes."""
    seen = {}
    real, real_rare = brown_lm.exchange, brown_lm.exchange_rare
    monkeypatch.setattr(brown_lm, "exchange", lambda near, n, *a: seen.setdefault("cls", real(near, n, *a)))
    monkeypatch.setattr(brown_lm, "exchange_rare", lambda *a: seen.setdefault("rare", real_rare(*a)))
    rng = np.random.default_rng(5)
    frequent = ["the", "a", "of"]
    texts = [" ".join(w for _ in range(30) for w in (rng.choice(frequent[:2]), f"n{rng.integers(60)}", "of", f"v{rng.integers(40)}",
                                                      f"V{rng.integers(9)}x")) for _ in range(30)]
    train = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tries = texts[:5] + ["the unseen of", "n1 n2 v3 new1! new2!", ""]
    got = brown_lm.score(spark.createDataFrame(list(enumerate(tries)), "doc_id long, text string"), train, classes=6, sweeps=3,
                         clustered=15, looked_up=3).toPandas().sort_values("doc_id")
    rare, t = seen["rare"]
    words = [brown_lm.words_of(x.encode()) for x in texts]
    count = Counter(w for ws in words for w in ws)
    state = {bytes(r.word): (r.k, r.c) for r in rare.collect()}
    top = sorted((w for w in count if count[w] >= sum(count.values()) / 15 and w != b"\n"), key=lambda w: (-count[w], w))
    assert len(top) == 3 and state.keys() | set(top) | {b"\n"} == count.keys()
    assert all(0 <= k < 6 and c == count[w] for w, (k, c) in state.items())
    cls = {w: k for w, (k, _) in state.items()} | dict(zip([b"\n", *top], seen["cls"].tolist()))
    n_cls = 6 + 1 + brown_lm.SHAPES
    want = np.zeros((n_cls, n_cls))
    for ws in words:
        for x, y in zip([ws[-1], *ws], ws):
            want[cls[x], cls[y]] += 1
    assert (t == want).all()
    share, kinds = (want.sum(0) + 0.5) / (want.sum() + 0.5 * n_cls), (want > 0).sum(1) + 1
    step = np.log10((want + kinds[:, None] * share) / (want.sum(1) + kinds)[:, None])
    for text, r in zip(tries, got.itertuples()):
        ws = brown_lm.words_of(text.encode())
        ks = [cls.get(w, 7 + brown_lm.shape(w)) for w in ws]
        value = sum(step[a, b] for a, b in zip([ks[-1], *ks], ks))
        value += sum(np.log10(count[w] / want[:, cls[w]].sum()) for w in ws if w in cls)
        assert r.score == pytest.approx(value, rel=1e-9) and r.n_known == sum(w in cls for w in ws)
    # words of like neighbours went together
    assert max(Counter(k for w, (k, _) in state.items() if w[:1] == b"n").values()) > 45


def test_edit_distance_within_is_the_tables_and_quicker():
    """op2 spent two thirds of its search in this distance."""
    def table(item, text):
        place, row = np.arange(len(text) + 1), np.zeros(len(text) + 1, np.int64)
        for i, word in enumerate(item):
            new = np.empty_like(row)
            new[0] = i + 1
            new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
            row = np.minimum.accumulate(new - place) + place
        return int(row.min()), int(row.argmin())

    def seconds(of):
        began = time.process_time()
        for _ in range(100):
            of(item, text)
        return time.process_time() - began

    rng = np.random.default_rng(3)
    for _ in range(400):
        item, text = (rng.integers(0, 5, rng.integers(0, n)) for n in (90, 120))
        assert decontam.edit_distance_within(item, text) == table(item, text)
    item, text = rng.integers(0, 500, 40), rng.integers(0, 500, 56)
    assert min(seconds(decontam.edit_distance_within) for _ in range(3)) < 0.6 * min(seconds(table) for _ in range(3))


def test_op6_shuffles_texts_once(spark, monkeypatch):
    """The labels are joined alike at any size; the words of all texts meet the
    few that mark them (which the driver gets) without a shuffle."""
    docs = spark.createDataFrame([(i, f"text {i} {'foul' if i % 2 else 'so'}", "en") for i in range(60)],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    stored, collected = [], []
    cut, collect = toxicity.cut, type(docs).collect
    monkeypatch.setattr(toxicity, "cut", lambda d, n: stored.append(d._jdf.queryExecution().analyzed().toString()) or cut(d, n))
    monkeypatch.setattr(type(docs), "collect", lambda d: collected.append(
        d._jdf.queryExecution().executedPlan().toString()) or collect(d))
    monkeypatch.setattr(toxicity, "score", lambda d, model, **k: model)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = toxicity.op6_query(docs, labels)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert "foul" in model.weights and "strategy=merge" in stored[0]
    assert any("BroadcastHashJoin" in p for p in collected) and not any("SortMergeJoin" in p for p in collected)
