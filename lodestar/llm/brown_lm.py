"""Brown class n-gram language model: exchange clustering, then scoring.

Every word of the training texts is put into a class by the exchange algorithm.
Words that make up at least 1/``CLUSTERED`` of the training tokens (so at most
``CLUSTERED`` of them, at any corpus size) are exchanged together, their classes
held in each task; rarer neighbours stand there by their written shape.  Then
each rarer word goes to the class that gains most by all its neighbours, twice:
its rarer neighbours count by shape, then by the class they went to, which they
tell one another by a shuffled join.  A text's probability is the product of
P(class | class before) and P(word | class); a word that was never seen has the
class of its written shape.

Counts cover the whole training corpus.  Words of at least 1/``LOOKED_UP`` of
the tokens are looked up in each task (at most ``LOOKED_UP`` entries); the
counts and classes of all rarer words reach the texts by a shuffled join.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, cut, ints, small, utf8

CLUSTERED = 1_000_000
LOOKED_UP = 1_000_000
CLASSES = 128
SWEEPS = 10
RARE_SWEEPS = 2
ALPHA = 0.1
END = b"\n"  # no word holds white space
HELD_ENTRIES = 200_000  # counts a task holds before it passes them on
HELD_PAIRS = 1_000_000  # pairs of words that it counts at a time

SHAPES = 24


def shape(word: bytes) -> int:
    """Shape class: length, digits, letters beyond ASCII, last character."""
    size = 0 if len(word) <= 4 else 1 if len(word) <= 8 else 2
    digit = any(48 <= b <= 57 for b in word)
    wide = not word.isascii()
    mark = word[-1] < 128 and not word[-1:].isalnum()
    return size + 3 * (digit + 2 * wide + 4 * mark)


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space, then the end token."""
    got = text.lower().split()
    got.append(END)
    return got


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, h, c) over all texts, h a hash of the word; counted in each task
    before the shuffle."""

    def count(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

        for batch in small(batches):
            for value in batch.column(0).to_pylist():
                held.update(words_of(value))
                if len(held) > HELD_ENTRIES:
                    yield out()
                    held.clear()
        if held:
            yield out()

    part = docs.select(utf8(text).alias("t")).mapInArrow(count, "word binary, c long")

    def hashed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _hashes(batch.column(0).to_pylist()), batch.column(1)], ["word", "h", "c"])

    return part.groupBy("word").agg(F.sum("c").alias("c")).mapInArrow(hashed, "word binary, h long, c long")


def _hashes(words) -> pa.Array:
    import xxhash

    return pa.array(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64))


class _Ids:
    """Ids of words: clustered words by rank, then one id for each shape."""

    def __init__(self, ranked: list[bytes]):
        self.n = len(ranked)
        self.rank = {w: i for i, w in enumerate(ranked)}

    def of(self, words: list[bytes], shapes: dict[bytes, int]) -> np.ndarray:
        got = np.fromiter(map(self.rank.get, words, repeat(-1)), np.int64, len(words))
        for i in np.nonzero(got < 0)[0].tolist():
            w = words[i]
            s = shapes.get(w)
            if s is None:
                if len(shapes) > HELD_ENTRIES:
                    shapes.clear()
                s = shapes[w] = shape(w)
            got[i] = self.n + s
        return got


def _neighbours(docs: DataFrame, text: str, ids) -> DataFrame:
    """For each id its neighbours: (w, x), x an array of ``_packed`` counts.

    A row holds at most two neighbours for each clustered word and shape.
    """
    width = ids.value.n + SHAPES

    def pairs(batches):
        table, shapes, held, size = ids.value, {}, [], 0

        def out():
            keys = np.concatenate(held)
            keys, n = np.unique(keys, return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys // width, pa.int32()), pa.array(keys % width, pa.int32()),
                 pa.array(n, pa.int64())], ["a", "b", "n"])

        for batch in small(batches):
            for value in batch.column(0).to_pylist():
                x = table.of(words_of(value), shapes)
                before = np.concatenate([x[-1:], x[:-1]])  # an end stands before the first word
                held.append(before * width + x)
                size += len(x)
                if size > 2_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    part = docs.select(utf8(text).alias("t")).mapInArrow(pairs, "a int, b int, n long")
    pair = part.groupBy("a", "b").agg(F.sum("n").alias("n"))
    packed = f"shiftleft(n, {_shift(width)}) + 2L *"
    sides = pair.selectExpr(f"explode(array(struct(a AS w, {packed} b + 1 AS x), struct(b AS w, {packed} a AS x))) AS r")
    return sides.groupBy("r.w").agg(F.collect_list("r.x").alias("x"))


def _by_entries(batches, column: int):
    """The same rows in batches of some ``HELD_PAIRS`` entries of a column of arrays."""
    for batch in batches:
        ends = batch.column(column).fill_null([]).offsets.to_numpy()
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + HELD_PAIRS, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi
    pa.default_memory_pool().release_unused()


def _shift(width: int) -> int:
    """Bits of a side and an id below ``width``."""
    return 1 + width.bit_length()


def _packed(n, other, side, shift: int = 33):
    """A count, an id (or class) and a side in 64 bits."""
    return n.astype(np.int64) << shift | other << 1 | side


def _contexts(batch: pa.RecordBatch, cls: np.ndarray, n_cls: int):
    """ids of the batch, and for each its counts by (side, class of neighbour)."""
    w = ints(batch.column(0))
    lists = batch.column(1)
    offsets = lists.offsets.to_numpy()
    x, shift = ints(lists.flatten()), _shift(len(cls))
    row = np.repeat(np.arange(len(w)), np.diff(offsets))
    slot = row * (2 * n_cls) + (x & 1) * n_cls + cls[x >> 1 & (1 << shift - 1) - 1]
    m = np.bincount(slot, weights=x >> shift, minlength=len(w) * 2 * n_cls)
    return w, m.reshape(len(w), 2, n_cls)


def _transitions(near: DataFrame, cls: np.ndarray, n_cls: int) -> np.ndarray:
    """Counts of class after class, summed over all words."""

    def count(batches):
        for batch in batches:
            w, m = _contexts(batch, cls, n_cls)
            for lo in range(0, len(w), 512):
                total = np.zeros((n_cls, n_cls))
                np.add.at(total, cls[w[lo:lo + 512]], m[lo:lo + 512, 1])
                a, b = np.nonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total[a, b])], ["a", "b", "n"])

    rows = near.mapInArrow(count, "a int, b int, n double").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((n_cls, n_cls))
    for r in rows:  # at most n_cls squared
        out[r.a, r.b] = r.n
    return out


def _likelihood(t: np.ndarray) -> float:
    """Log likelihood of the classes, up to a constant of the words alone."""
    into, total = t.sum(0), t.sum(1)
    some = t[t > 0]
    return float((some * np.log(some)).sum() - (into[into > 0] * np.log(into[into > 0])).sum()
                 - (total[total > 0] * np.log(total[total > 0])).sum())


def exchange(near: DataFrame, n_words: int, classes: int, sweeps: int, fixed: int) -> np.ndarray:
    """Class of every id by exchange clustering.

    A sweep moves each word to the class that gains most under the present
    transition counts; half of the words move at a time (by the parity of
    their rank and the sweep), so that two words do not chase one another.
    Returns the best assignment met.  ``fixed`` ids after the words, and the
    end token (rank 0), keep classes of their own.
    """
    n_cls = classes + 1 + fixed
    cls = np.empty(n_words + fixed, np.int64)
    cls[:n_words] = np.arange(n_words) % classes
    cls[n_words:] = classes + 1 + np.arange(fixed)
    cls[:1] = classes
    best, best_at = cls, -np.inf
    for sweep in range(sweeps + 1):
        t = _transitions(near, cls, n_cls)
        at = _likelihood(t)
        if at > best_at:
            best, best_at = cls, at
        if sweep == sweeps or n_words <= 1:
            break
        total = np.maximum(t.sum(0), 1.0)
        p = (t + 0.1 * total[None, :] / total.sum() * n_cls) / (t.sum(1) + 0.1 * n_cls)[:, None]
        gain = np.concatenate([np.log(p)[:, :classes], np.log(p).T[:, :classes]])  # before, after

        def moves(batches, cls=cls, gain=gain, total=total, sweep=sweep):
            for batch in batches:
                w, m = _contexts(batch, cls, n_cls)
                own = m[:, 1].sum(1)
                value = m.reshape(len(w), -1) @ gain
                size = np.repeat(total[None, :classes], len(w), 0)
                inside = np.arange(classes)[None, :] == cls[w][:, None]
                value -= own[:, None] * np.log(np.where(inside, size, size + own[:, None]))
                move = (w < n_words) & (w > 0) & ((w + w // classes + sweep) % 2 == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[move], pa.int32()), pa.array(value[move].argmax(1), pa.int32())], ["w", "k"])

        cls = cls.copy()
        for batch in near.mapInArrow(moves, "w int, k int").toArrow().to_batches():  # at most a row for each clustered word
            cls[ints(batch.column(0))] = ints(batch.column(1))
    return best


def _beside(docs: DataFrame, text: str, ids) -> DataFrame:
    """Neighbours of the words without an id, as counted in each task: (h, word,
    x, near, n), x an array of ``_packed`` counts.

    A word's rows with ``x`` hold all its neighbours, words without an id by
    their shape; pairs of the latter have a row each, ``near`` before ``h``.
    Such words are known by their hashes, which no two of them share.
    """
    first = ids.value.n + SHAPES

    def pairs(batches):
        table, shapes, local, held, size = ids.value, [], {}, [], 0

        def out():
            words, h = pa.array(list(local), pa.binary()), _hashes(local)
            shaped = np.concatenate([np.arange(first), table.n + np.array(shapes, np.int64)])
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            a, b = keys >> 32, keys & 0xFFFFFFFF
            both = (a >= first) & (b >= first)
            w = np.concatenate([b[b >= first], a[a >= first]]) - first
            x = np.concatenate([_packed(n, shaped[a], 0)[b >= first], _packed(n, shaped[b], 1)[a >= first]])
            order = np.argsort(w, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(w, minlength=len(words)))])
            none = pa.nulls(len(words), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [h, words, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x[order])), none, none], names)
            if both.any():
                h, size = ints(h), int(both.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[b[both] - first]), pa.nulls(size, pa.binary()), pa.nulls(size, pa.list_(pa.int64())),
                     pa.array(h[a[both] - first]), pa.array(n[both].astype(np.int64))], names)

        for batch in small(batches):
            for value in batch.column(0).to_pylist():
                toks = words_of(value)
                x = np.fromiter(map(table.rank.get, toks, repeat(-1)), np.int64, len(toks))
                for i in np.nonzero(x < 0)[0].tolist():
                    at = local.setdefault(toks[i], len(local))
                    if at == len(shapes):
                        shapes.append(shape(toks[i]))
                    x[i] = first + at
                before = np.concatenate([x[-1:], x[:-1]])
                rare = (before >= first) | (x >= first)
                held.append(before[rare] << 32 | x[rare])
                size += len(held[-1])
                if size > HELD_PAIRS or len(local) > HELD_ENTRIES:
                    yield from out()
                    shapes, local, held, size = [], {}, [], 0
        if size:
            yield from out()

    names = ["h", "word", "x", "near", "n"]
    return docs.select(utf8(text).alias("t")).mapInArrow(pairs, "h long, word binary, x array<long>, near long, n long")


def _groups(batches):
    """Batches of whole words from rows sorted by their hash, and where each begins."""
    left = None
    for batch in _by_entries(batches, 2):
        if left is not None:
            batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
        h = ints(batch.column(0))
        begins = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        left = batch.slice(begins[-1])
        if begins[-1]:
            yield batch.slice(0, begins[-1]), begins[:-1]
    if left is not None:
        yield left, np.zeros(1, np.int64)


def exchange_rare(beside: DataFrame, t: np.ndarray, cls: np.ndarray, n_words: int, classes: int,
                  sweeps: int = RARE_SWEEPS) -> tuple[DataFrame, np.ndarray]:
    """Classes of the words of ``beside``, (word, k, c), and the counts of class
    after class with them.  ``t`` and ``cls`` are those of the words with ids.

    In a sweep each word goes to the class that gains most under the present
    counts.  A task holds the neighbours of some words; neighbours without an id
    count by shape in the first sweep, and later tell their class by a join.
    """
    n_cls = len(t)
    own = beside.filter("near IS NULL").selectExpr("h", "word", "x", "CAST(NULL AS LONG) AS said")
    pairs = beside.filter("near IS NOT NULL").select("h", "near", "n")
    fixed = np.zeros_like(t)
    fixed[:classes + 1, :classes + 1] = t[:classes + 1, :classes + 1]  # of words with ids alone

    def counts(rows) -> np.ndarray:
        out = np.zeros((n_cls, n_cls))
        for r in rows.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():  # at most n_cls squared
            out[r.a, r.b] = r.n
        return out

    def assign(rows: DataFrame, t: np.ndarray, told: bool) -> DataFrame:
        total = np.maximum(t.sum(0), 1.0)
        p = (t + 0.1 * total[None, :] / total.sum() * n_cls) / (t.sum(1) + 0.1 * n_cls)[:, None]
        gain = np.concatenate([np.log(p)[:, :classes], np.log(p).T[:, :classes]])  # before, after

        def run(batches):
            known, rare = np.zeros(n_cls * n_cls), np.zeros(n_cls * n_cls)
            for batch, begins in _groups(batches):
                group = np.zeros(batch.num_rows, np.int64)
                group[begins[1:]] = 1
                group = np.cumsum(group)
                lists, said = batch.column(2).fill_null([]), batch.column(3)
                x = ints(lists.flatten())
                g = group[np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))]
                n, other, side = x >> 33, x >> 1 & 0xFFFFFFFF, x & 1
                c = np.bincount(g, weights=n * (side == 0), minlength=len(begins))
                by_id, other = other < n_words, cls[other]
                now = np.full(len(begins), -1)
                if told:  # the own class is a negative number
                    spoke = np.flatnonzero(ints(said.is_valid()))
                    x, at = ints(said.drop_null()), group[spoke]
                    now[at[x < 0]] = -1 - x[x < 0]
                    at, x = at[x >= 0], x[x >= 0]
                    g, n, side, other = (np.concatenate([old[by_id], new]) for old, new in (
                        (g, at), (n, x >> 33), (side, x & 1), (other, x >> 1 & 0xFFFFFFFF)))
                    by_id = np.arange(len(g)) < by_id.sum()
                    order = np.argsort(g, kind="stable")
                    g, n, side, other, by_id = g[order], n[order], side[order], other[order], by_id[order]
                best = np.empty(len(begins), np.int64)
                for lo in range(0, len(begins), 1024):
                    hi = min(lo + 1024, len(begins))
                    i, j = np.searchsorted(g, [lo, hi])
                    m = np.bincount((g[i:j] - lo) * (2 * n_cls) + side[i:j] * n_cls + other[i:j], weights=n[i:j],
                                    minlength=(hi - lo) * 2 * n_cls).reshape(hi - lo, -1)
                    inside = np.arange(classes)[None, :] == now[lo:hi, None]
                    own_n = c[lo:hi, None]
                    value = m @ gain
                    value -= own_n * np.log(np.where(inside, total[None, :classes], total[None, :classes] + own_n))
                    best[lo:hi] = value.argmax(1)
                k = best[g]
                after = np.where(side == 0, other * n_cls + k, k * n_cls + other)
                known += np.bincount(after[by_id], weights=n[by_id], minlength=len(known))
                some = ~by_id & (side == 0)  # a pair of words without ids counts once
                rare += np.bincount(after[some], weights=n[some], minlength=len(rare))
                none = pa.nulls(len(begins), pa.int32())
                named = np.flatnonzero(ints(batch.column(1).is_valid()))
                named = named[np.flatnonzero(np.diff(group[named], prepend=-1))]  # a row with the word for each group
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(begins)), batch.column(1).take(pa.array(named)), pa.array(best, pa.int32()),
                     pa.array(c.astype(np.int64)), none, none,
                     pa.nulls(len(begins), pa.float64()), pa.nulls(len(begins), pa.bool_())], names)
            for by_id, of in ((True, known), (False, rare)):
                at = np.flatnonzero(of)
                none = pa.nulls(len(at), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()), none, pa.nulls(len(at), pa.int64()),
                     pa.array(at // n_cls, pa.int32()),
                     pa.array(at % n_cls, pa.int32()), pa.array(of[at]), pa.array([by_id] * len(at), pa.bool_())], names)

        names = ["h", "word", "k", "c", "a", "b", "n", "by_id"]
        return cut(rows.repartition("h").sortWithinPartitions("h").mapInArrow(
            run, "h long, word binary, k int, c long, a int, b int, n double, by_id boolean"), "brown-rare")

    def told(state: DataFrame) -> DataFrame:
        """The words' neighbours, own class and the classes of those neighbours that have no id."""
        both = pairs.selectExpr("n", "explode(array(struct(h AS to, near, 0L AS side), struct(near AS to, h AS near, 1L AS side))) AS r")
        said = both.selectExpr("r.*", "n").join(state.selectExpr("h AS near", "k"), "near")
        no_word = "CAST(NULL AS BINARY) AS word", "CAST(NULL AS ARRAY<BIGINT>) AS x"
        return (own.unionByName(state.selectExpr("h", *no_word, "-1L - k AS said"))
                .unionByName(said.selectExpr("to AS h", *no_word, "shiftleft(n, 33) + 2L * k + side AS said")))

    rows = own
    for sweep in range(sweeps):
        made = assign(rows, t, sweep > 0)
        state, sums = made.filter("h IS NOT NULL").select("h", "word", "k", "c"), made.filter("h IS NULL")
        known = fixed + counts(sums.filter("by_id"))
        if sweep + 1 < sweeps:
            t = known + counts(sums.filter("NOT by_id"))
            rows = told(state)
    between = pairs.join(state.selectExpr("h AS near", "k AS a"), "near").join(state.selectExpr("h", "k AS b"), "h")
    return state.select("word", "k", "c"), known + counts(between.select("a", "b", "n"))


def score(docs: DataFrame, train: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          classes: int = CLASSES, sweeps: int = SWEEPS, clustered: int = CLUSTERED,
          looked_up: int = LOOKED_UP) -> DataFrame:
    """Log10 probabilities of all texts of ``docs`` under a model of ``train``.

    Returns ``keep`` and n_tokens, n_known, train_tokens, base_score (add-0.1
    unigrams) and score (class bigrams), a row for each row of ``docs``.  A
    null text counts as empty: one end token.  Repeated rows and ids stay
    apart.  With no training text every word is unknown.  All words of ``train``
    are clustered; those of at least 1/``clustered`` of the tokens together, in
    tasks that hold their ids, the rarer ones after them.
    """
    if classes + 1 + SHAPES >= 1 << 14:
        raise ValueError("classes are numbers of 14 bits")
    spark = docs.sparkSession
    words = cut(word_counts(train, text), "brown-words")
    total = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = total.n or 0, total.v or 0
    floor = max(1.0, n / max(looked_up, clustered))
    # words that share a hash (hardly ever any) are held as if they were frequent
    shared = [r.h for r in words.groupBy("h").count().filter("count > 1").select("h").collect()]
    frequent = words.filter((F.col("c") >= floor) | (F.col("word") == END) | F.col("h").isin(shared)).orderBy(F.desc("c"), "word").toArrow()
    names, counts = frequent.column("word").to_pylist(), ints(frequent.column("c")).astype(float)
    shared = set(shared)
    by_rank = [w for w, c, h in zip(names, counts, frequent.column("h").to_pylist())
               if (c >= max(1.0, n / clustered) or h in shared) and w != END]
    ids = spark.sparkContext.broadcast(_Ids([END, *by_rank]))
    n_words = 1 + len(by_rank)

    near = cut(_neighbours(train, text, ids), "brown-near")
    cls = exchange(near, n_words, classes, sweeps, SHAPES)
    n_cls = classes + 1 + SHAPES
    t = _transitions(near, cls, n_cls)
    class_of = dict(zip([END, *by_rank], cls.tolist()))
    rare = None
    if v > n_words:
        rare, t = exchange_rare(cut(_beside(train, text, ids), "brown-beside"), t, cls, n_words, classes)
        if floor < n / clustered:  # looked up, but not clustered with the others
            got = rare.filter(F.col("c") >= floor).select("word", "k").toArrow()
            class_of.update(zip(got.column("word").to_pylist(), got.column("k").to_pylist()))

    # P(class | class before): Witten-Bell between the counts and the classes' own share
    share = (t.sum(0) + 0.5) / (t.sum() + 0.5 * n_cls)
    kinds = (t > 0).sum(1) + 1.0
    step = np.log10((t + kinds[:, None] * share[None, :]) / (t.sum(1) + kinds)[:, None])
    log_inside = np.log10(np.maximum(t.sum(0), 1.0))  # the tokens of a class
    log_base = float(np.log10(n + ALPHA * (v + 1)))

    if END not in names:
        names, counts = [*names, END], np.append(counts, 0.0)
    known_cls = np.array([class_of[w] for w in names])
    model = spark.sparkContext.broadcast({
        "slot": {w: i for i, w in enumerate(names)}, "cls": known_cls, "log_c": np.log10(counts + ALPHA), "seen": counts > 0,
        "emit": np.where(counts > 0, np.log10(np.maximum(counts, 1.0)) - log_inside[known_cls], 0.0),
        "step": step, "log_inside": log_inside})

    def run(batches):
        m, shapes = model.value, {}
        slot, step = m["slot"], m["step"]
        for batch in small(batches):
            cols = {k: [] for k in ("n_tokens", "n_known", "base", "score")}
            rare_words, rare_shapes, rare_at, rare_ends = [], [], [], [0]
            for value in batch.column(1).to_pylist():
                toks = words_of(value)
                s = np.fromiter(map(slot.get, toks, repeat(-1)), np.int64, len(toks))
                found = s >= 0
                c = np.where(found, m["cls"][s], -1)
                before = np.concatenate([c[-1:], c[:-1]])  # an end stands before the first word
                both = found & (before >= 0)
                here = s[found]
                cols["n_tokens"].append(len(toks))
                cols["n_known"].append(int(m["seen"][here].sum()))
                cols["base"].append(float(m["log_c"][here].sum() - len(toks) * log_base))
                cols["score"].append(float(step[before[both], c[both]].sum() + m["emit"][here].sum()))
                # the end token is always found, so something follows each of these
                late = np.nonzero(~found)[0]
                rare_at.append(late << 33 | before[late] + 1 << 19 | c[late + 1] + 1 << 5)
                missing = [toks[i] for i in late.tolist()]
                if len(shapes) > HELD_ENTRIES:
                    shapes.clear()
                for w in set(missing):
                    if w not in shapes:
                        shapes[w] = shape(w)
                rare_words += missing
                rare_shapes += [shapes[w] for w in missing]
                rare_ends.append(len(rare_words))
            rare_rows = pa.StructArray.from_arrays(  # place, class before, class after and shape are one number
                [pa.array(rare_words, pa.binary()), pa.array(np.concatenate(rare_at) | np.array(rare_shapes, np.int64))], ["word", "at"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(cols["n_tokens"], pa.int64()), pa.array(cols["n_known"], pa.int64()),
                 pa.array(cols["base"], pa.float64()), pa.array(cols["score"], pa.float64()),
                 pa.ListArray.from_arrays(pa.array(rare_ends, pa.int32()), rare_rows)],
                ["rid", "keep", "n_tokens", "n_known", "base", "score", "rare"])

    def late(batches):
        """Sums over the rare words of a text, which come in order: its base,
        score and known words."""
        m = model.value
        step, last, open_rid, open_sums = m["step"], (-1, -1, 0), None, None

        def out(rid, sums):
            return pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), *(pa.array(x, pa.float64()) for x in sums)],
                                              ["rid", "late_base", "late_score", "late_known"])

        for batch in small(batches, 4096):
            rid, at, k, c = (ints(x) for x in batch.columns)
            left, right, at = (at >> 19 & 0x3FFF) - 1, (at >> 5 & 0x3FFF) - 1, at >> 33
            seen = c > 0
            value = np.where(seen, np.log10(np.maximum(c, 1)) - m["log_inside"][k], 0.0)
            value += np.where(left >= 0, step[left, k], 0.0) + np.where(right >= 0, step[k, right], 0.0)
            rid0, at0, k0 = (np.concatenate([[x], y[:-1]]) for x, y in zip(last, (rid, at, k)))
            value += np.where((rid0 == rid) & (at0 + 1 == at), step[k0, k], 0.0)
            last = rid[-1], at[-1], k[-1]
            begins = np.flatnonzero(np.concatenate([[True], rid[1:] != rid[:-1]]))
            sums = np.stack([np.add.reduceat(x, begins) for x in (np.log10(c + ALPHA), value, seen.astype(float))])
            rids = rid[begins]
            if open_rid is not None:
                if open_rid == rids[0]:
                    sums[:, 0] += open_sums
                else:
                    yield out([open_rid], open_sums[:, None])
            open_rid, open_sums = rids[-1], sums[:, -1]
            yield out(rids[:-1], sums[:, :-1])
        if open_rid is not None:
            yield out([open_rid], open_sums[:, None])

    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), utf8(text).alias("t"),
                           F.struct(*[F.col(c) for c in keep]).alias("keep"))
    rare_type = "array<struct<word: binary, at: long>>"
    # the written table fixes the row numbers
    scored = cut(numbered.mapInArrow(
        run, f"rid long, keep {numbered.schema['keep'].dataType.simpleString()}, n_tokens long, n_known long, "
             f"base double, score double, rare {rare_type}"), "brown-scored")
    # rare words, in each text and in training
    here = scored.select("rid", F.explode("rare").alias("r")).select("rid", "r.*")
    if rare is None:
        here = here.selectExpr("*", "CAST(NULL AS INT) AS k", "CAST(NULL AS LONG) AS c")
    else:
        here = here.join(rare.filter(F.col("c") < floor), "word", "left")
    placed = here.selectExpr("rid", "at", f"coalesce(k, CAST((at & 31) + {classes + 1} AS INT)) AS k", "coalesce(c, 0L) AS c")
    more = placed.repartition("rid").sortWithinPartitions("rid", "at").mapInArrow(
        late, "rid long, late_base double, late_score double, late_known double")
    added = [F.coalesce(c, F.lit(0.0)) for c in ("late_base", "late_score", "late_known")]
    return (scored.drop("rare").join(more, "rid", "left")
            .select("keep.*", "n_tokens", (F.col("n_known") + added[2].cast("long")).alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("base") + added[0]).alias("base_score"), (F.col("score") + added[1]).alias("score")))


def op1_query(docs: DataFrame) -> DataFrame:
    """Scores of all documents, learned from those whose crc32 leaves no 0."""
    rows = docs.select("doc_id", "text", (crc_mod("doc_id", 10) == 0).alias("held_out"))
    return score(rows, rows.filter(~F.col("held_out")), keep=("doc_id", "held_out"))
