"""SimHash, decontamination, nearest neighbours, packing, token store,
licenses, chat formatting and the pipeline."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lodestar.llm import ann_tree, chat_format, decontam, license_scan, packing, repair_store, simhash
from lodestar.llm.components import components
from lodestar.llm.queries import LLM_QUERIES
from lodestar.llm.tokens import PieceEncoder, tokenizer_file

SMALL = "/root/testdata/sf0.001"


# ---- SimHash ----------------------------------------------------------------

def _plain_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_components(prints, distance=4):
    u, inv = np.unique(np.array(prints, np.uint64), return_inverse=True)
    root = np.arange(len(u))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(u)):
        for j in np.nonzero(np.bitwise_count(u[i + 1:] ^ u[i]) <= distance)[0] + i + 1:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in inv]


def test_simhash_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == {d: _plain_fingerprint(t) for d, t in texts.items()}
    label = _brute_components([int(r.fingerprint, 16) for r in got])
    least = {}
    for r, x in zip(got, label):
        least[x] = min(least.get(x, r.doc_id), r.doc_id)
    assert all(r.component_id == least[x] for r, x in zip(got, label))


def test_simhash_link_finds_every_ball(spark):
    """Planted fingerprints at 0 to 6 bits, chains, and a dense group."""
    rng = np.random.default_rng(2)
    prints = []
    for _ in range(150):
        x = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(2))
        prints.append(x)
        for n in range(1, 7):
            prints.append(x ^ sum(1 << int(b) for b in rng.choice(64, n, replace=False)))
    centre = prints[0]
    prints += [centre ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(300)]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p, 1) for p in signed], "fp long, n long")
    label = {r.fp: r.label for r in simhash.link(nodes).collect()}
    want = _brute_components(prints)
    assert len({(label[p], w) for p, w in zip(signed, want)}) == len(set(want)) == len(set(label.values()))


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[501] == 500


def test_components_of_many_chunks(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(300)] + [(int(a), int(b)) for a, b in rng.integers(1000, 1600, (400, 2))]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    frame = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = components(frame, task_edges=50).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((i, find(i)) for i in root if find(i) != i)


def test_simhash_link_in_few_jobs(spark):
    """A chain and a dense group do not take a round of jobs for each step."""
    prints = {0} | {(1 << i) - 1 for i in range(60)} | {(1 << 63) - 1 ^ 1 << i ^ 1 << j for i in range(60) for j in range(i)}
    nodes = spark.createDataFrame([(p, 1) for p in sorted(prints)], "fp long, n long")
    spark.sparkContext.setJobGroup("simhash-few", "")
    try:
        label = {r.fp: r.label for r in simhash.link(nodes).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert label == {p: 0 for p in prints}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("simhash-few")) < 80


def test_simhash_odd_and_one_of_each(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == 9
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} >= {2, 3} and {r.component_id for r in zero} == {2}
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len({r.component_id for r in got})
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


# ---- decontamination --------------------------------------------------------

def test_decontamination_finds_exact_and_edited_copies(spark):
    items = [decontam.words_in(r.text.lower()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    block = decontam.Block(items, 0.8, 3, 0.99)
    rng, rows = np.random.default_rng(5), []
    hosts = [decontam.words_in(r.text.lower())[:200] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(50).collect()]
    for k in range(400):
        i = k % len(items)
        x = list(items[i])
        for _ in range(decontam.edits_allowed(len(x))):
            at = int(rng.integers(len(x)))
            x[at:at + 1] = [[], ["zz"], ["zz", x[at]]][int(rng.integers(3))]
        host = hosts[k % len(hosts)]
        at = int(rng.integers(len(host) + 1))
        rows.append((i, host[:at] + x + host[at:]))
    found = block.search([x for _, x in rows])
    assert np.mean([any(m[0] == i for m in f) for (i, _), f in zip(rows, found)]) > 0.97
    for (_, words), f in zip(rows, found):  # every match is one
        for i, d, start, n in f:
            assert decontam.edit_distance_within(block.ids[i], np.array([block.vocabulary.get(w, 0) for w in words[start:start + n]]))[0] == d


def test_decontamination_query_equals_exact_search(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in LLM_QUERIES["op2_decontaminate"](spark, "/root/testdata/sf0.01").collect()}
    items = {r.item_id: " ".join(decontam.words_in(r.text.lower())) for r in bench.collect()}
    exact = {(r.doc_id, i) for r in docs.collect() for i, x in items.items()
             if f" {x} " in " " + " ".join(decontam.words_in((r.text or "").lower())) + " "}
    assert exact and exact <= got


def test_decontamination_odd_blocks_and_short_items(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "sat on the mat with"), (2, None), (3, ""), (4, "hund"), (5, "sat on the mat with"),
                                   (6, "die katze")], "item_id long, text string")
    for words in (200_000, 3):  # also with the benchmark in several blocks
        got = decontam.contamination(odd_docs, bench, keep=("doc_id", "score", "t"), block_words=words)
        assert got.count() == 9
        rows = [(r.doc_id, sorted(m.item_id for m in r.matches)) for r in got.collect() if r.matches]
        assert sorted(rows, key=str) == sorted([(1, [1, 5]), (1, [1, 5]), (None, [4, 6])], key=str)
    assert decontam.contamination(no_docs, bench).count() == 0
    assert decontam.contamination(odd_docs, bench.limit(0)).filter(F.size("matches") > 0).count() == 0


# ---- nearest neighbours -----------------------------------------------------

def test_ann_recall_and_scores(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = e.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = defaultdict(list)
    for r in ann_tree.search(e, e.filter("vec_id % 10 = 0"), leaf=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hit = []
    for q, near in got.items():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        hit.append(len({int(ids[i]) for i in order} & {v for v, _ in near}) / 10)
        at = dict(zip(ids.tolist(), d))
        assert len(near) == 10 and near == sorted(near, key=lambda p: (p[1], p[0])) and all(abs(at[v] - s) < 1e-12 for v, s in near)
    assert len(got) == sum(i % 10 == 0 for i in ids) and np.mean(hit) >= 0.9


def test_ann_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(0, 40)] + [(100, None), (200, [0.0, 0.0]), (300, [nan, 1.0]), (400, [inf, 1.0]),
                                                   (500, []), (600, [1.0, None]), (700, [5.0, 5.0, 5.0]), (800, [1.0, 3.0])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann_tree.op3_query(e).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == {0: list(range(1, 11)), 800: list(range(10))}
    assert ann_tree.op3_query(e.limit(0)).count() == 0
    assert [r.vec_id for r in ann_tree.op3_query(e.filter("vec_id in (0, 800)")).orderBy("query_id").collect()] == [800, 0]


# ---- tokens, packing, store -------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abtheTHE's .,!?\n\t 1²é́İΣς中’|<>_-\0\x1c\xa0", max_size=30), max_size=5))
def test_pieces_equal_the_library(texts):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        coder = PieceEncoder(tokenizer_file(name))
        assert coder.encode(texts) == coder._library(texts)
        assert coder.encode(texts) == coder._library(texts)  # from what is kept


def _ids(name, text, end):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_file(name)).encode(text or "", add_special_tokens=False).ids + [end]


def test_packing_holds_every_id_once(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(80).select("doc_id", "text") \
        .union(odd_docs.filter("doc_id >= 2").select(F.col("doc_id") + 10_000, "text"))
    want = {r.doc_id: _ids("byte_bpe_50k.json", r.text, 0) for r in docs.collect()}
    rows = packing.pack(docs, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.doc_tokens == len(want[r.doc_id])
        pieces[r.doc_id].append((r.start, r.ids))
        sequences[r.sequence_id].append((r.offset, r.length, r.tier, r.step_id))
    assert {d: [i for _, x in sorted(p) for i in x] for d, p in pieces.items()} == want
    padding, steps = 0, Counter()
    for s in sequences.values():
        at = 0
        for offset, length, *_ in sorted(s):
            assert offset == at
            at += length
        assert at <= s[0][2] <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
        steps[s[0][3]] += s[0][2]
    assert padding < 1024 * docs.rdd.getNumPartitions() and max(steps.values()) <= 8 * 1024
    assert packing.pack(no_docs).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(0, 70_000), st.integers(0, 50), st.integers(1, 50))
def test_re_pair_round_trip(ids, high, start, length):
    ids = np.array(ids + [high] if high > 60_000 else ids, np.uint32)
    shard = repair_store.Shard(repair_store.compress(ids, least=2))
    assert (shard.decode() == ids).all() and len(shard) == len(ids)
    assert (shard.decode(start, length) == ids[start:start + length]).all()


def test_store_round_trip(spark, scratch, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).select("doc_id", "text") \
        .union(odd_docs.filter("doc_id >= 2").select(F.col("doc_id") + 10_000, "text"))
    path = scratch("ids")
    repair_store.write_ids(docs, path, shard_ids=5_000)
    got = {r.doc_id: r for r in repair_store.read_ids(spark, path, with_ids=True).collect()}
    start = 0
    for r in docs.orderBy("doc_id").collect():
        ids = _ids("word_bpe_49k.json", r.text, 2)
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, list(g.ids)) == (start, len(ids), ids)
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    path = scratch("odd")
    repair_store.write_ids(odd_docs, path)
    assert repair_store.read_ids(spark, path).count() == 9
    path = scratch("none")
    repair_store.write_ids(no_docs, path)
    assert repair_store.read_ids(spark, path).count() == 0


def test_nearest_of_a_full_group_is_bounded():
    import tracemalloc
    rng = np.random.default_rng(3)
    points, queries = rng.normal(size=(20_000, 4)), rng.normal(size=(20_000, 4))
    ids = rng.permutation(20_000)
    tracemalloc.start()
    q, v, d = ann_tree._nearest(queries, ids, points, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300_000_000 and len(q) == 60_000
    for j in (0, 199, 200, 12_345, 19_999):
        far = np.sqrt(((points - queries[j]) ** 2).sum(1))
        first = np.lexsort((ids, far))[:3]
        assert v[q == j].tolist() == ids[first].tolist() and d[q == j].tolist() == far[first].tolist()


def test_grammar_leaves_no_frequent_pair():
    rng = np.random.default_rng(9)
    phrases = [rng.integers(0, 500, rng.integers(2, 60)) for _ in range(300)]
    for ids in (np.concatenate([phrases[i] for i in rng.integers(0, 300, 3000)]), np.full(5000, 7),
                np.concatenate([rng.integers(65_000, 65_400, 60_000)])):
        shard = repair_store.Shard(repair_store.compress(ids))
        pairs = Counter(zip(shard.symbols[:-1].tolist(), shard.symbols[1:].tolist()))
        assert max(pairs.values(), default=0) < repair_store.LEAST
        assert shard.decode(0, len(ids)).tolist() == ids.tolist()


# ---- licenses ---------------------------------------------------------------

def test_license_blocks_and_differences(spark, odd_docs, no_docs):
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    apache = license_scan.TEMPLATES["Apache-2.0 header"]
    changed = apache.replace("you may not use", "you shall never use").replace("agreed to", "consented to")
    for text, name, n in (("prose here\nReleased under the MIT License.\nmore", "MIT", 0), (changed, "Apache-2.0 header", 3),
                          ("x " * 3000 + license_scan.TEMPLATES["ISC"] + " y" * 3000, "ISC", 0),
                          ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 0), ("Licensed under CC BY 4.0.", "CC-BY-4.0", 0)):
        (found,) = scanner.text(text)
        assert (found[1], found[5]) == (name, n)
    for text in ("", "he has a driving licence", "the copyright of this song is hers alone and she sells it"):
        assert scanner.text(text) == []
    assert license_scan.differences("a b c d".split(), "z a x c d e".split()) == (1, ["-b", "+x"])
    assert license_scan.scan(odd_docs).count() == 0 and license_scan.scan(no_docs).count() == 0


def test_license_templates_in_customary_line_breaks():
    import textwrap
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    for name, template in license_scan.TEMPLATES.items():
        for width in (70, 75, 80):
            for mark in ("", "# ", " * "):
                wrapped = textwrap.fill(template, width, initial_indent=mark, subsequent_indent=mark)
                wrapped = wrapped.replace("conditions: The", "conditions:\n\nThe").replace("met: Re", "met:\n\nRe")
                assert [x[1] for x in scanner.text(f"some code\n\n{wrapped}\n\nmore of it\n")] == [name], (name, width)
    mit = license_scan.TEMPLATES["MIT text"].replace("conditions: ", "conditions:\n\n")
    assert [x[1] for x in scanner.text(mit)] == ["MIT text"]


def test_license_inside_paragraphs_and_side_by_side():
    import random
    scanner, rng = license_scan.Scanner(license_scan.TEMPLATES), random.Random(4)
    prose = "river stone walks under morning light and sings of old houses by seas with green hills".split()
    for name, template in license_scan.TEMPLATES.items():
        for n in (60, 130, 2000):
            text = " ".join(rng.choices(prose, k=n)) + ". " + template
            ((at, got, *_),) = scanner.text(text + " " + " ".join(rng.choices(prose, k=n)))
            assert (got, at) == (name, len(text) - len(template))
    t = license_scan.TEMPLATES
    for pair in (["MIT", "Apache-2.0"], ["GPL-3.0 header", "MIT text"], ["MIT", "MIT"], ["ALL RIGHTS RESERVED", "MIT"]):
        both = "\n".join(t.get(p, p) for p in pair)
        assert [x[1] for x in scanner.text(both)] == [p.replace("ALL RIGHTS RESERVED", "All rights reserved") for p in pair]
    many = "\n".join([t["MIT text"], t["MIT"]] * 60)
    assert [x[1] for x in scanner.text(many)] == ["MIT text", "MIT"] * 60


def test_license_query_finds_every_line(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lines = docs.filter(F.col("text").rlike("(?i)license|rights reserved")).select("doc_id").distinct().count()
    assert lines and license_scan.scan(docs).select("doc_id").distinct().count() == lines


# ---- chat -------------------------------------------------------------------

ODD = ["<|im_end|>", "<\\|im_end|>", "<\\\\|im_start|>x", "a\nb", "", None, "\\n", "<|im_end|>\n<|im_start|>assistant\nhi"]


def test_chat_round_trip_and_examples(spark):
    rows = [(c, t, ["user", "assistant", "system\n\\x", None][(c + t) % 4], ODD[(3 * c + t) % len(ODD)])
            for c in range(8) for t in range(6)] + [(None, None, "user", "x"), (3, 1, "assistant", "again"), (3, 1, "assistant", "again")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    stored = chat_format.format_turns(turns)
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t if t is not None else -1, role or "", text or ""))
    got = {r.conv_id: r for r in chat_format.read_digest(stored).collect()}
    assert got.keys() == by.keys()
    for c, ts in by.items():
        ts.sort()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in ts).encode()).hexdigest()
        loss = "".join(x for _, r, x in ts if r == "assistant")
        assert (got[c].loss_sha256, got[c].loss_chars) == (hashlib.sha256(loss.encode()).hexdigest(), len(loss))
        assert got[c].n_examples == sum(r == "assistant" for _, r, _ in ts) and got[c].n_turns == len(ts)
    for r in chat_format.expand(stored).collect():  # all turns before are the context
        before = sorted(by[r.conv_id])[:r.seq - 1]
        assert r.context.count(chat_format.START) == len(before) + 1 and r.context.endswith("assistant\n")
        assert chat_format.unescape(r.target) == sorted(by[r.conv_id])[r.seq - 1][2]
    assert chat_format.read_digest(chat_format.format_turns(turns.limit(0))).count() == 0


def test_chat_query_adds_the_probe(spark):
    got = {r.conv_id: r for r in LLM_QUERIES["op8_chat_format"](spark, SMALL).collect()}
    text = "<|im_end|><|im_start|>assistant ok"
    assert got[-1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[-1].n_turns == 2


# ---- pipeline ---------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("row", F.lit(1)).withColumn("rejected", F.lit(2)) \
        .withColumn("matches", F.lit("m"))
    junk = spark.createDataFrame([(10**6, None, None, None, 0, 1, 2, "m"), (10**6 + 1, "1 2 3", None, None, 5, 1, 2, "m")], docs.schema)
    now, seen = docs.union(junk), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
            kept = {r.doc_id for r in out.select("doc_id").collect()}
            seen.append(len(kept))
            now = corpus_pipeline.cut(out, f"test-{name}")
    assert seen[0] >= 198 and 10**6 not in kept and seen == sorted(seen, reverse=True) and seen[-1] > 120
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == kept


def test_queries_are_registered():
    assert sorted(LLM_QUERIES) == sorted(["pipeline", *(n for n in LLM_QUERIES if n.startswith("op"))])
    assert {n.split("_")[0] for n in LLM_QUERIES if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}
