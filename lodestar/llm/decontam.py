"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A benchmark item is looked for in item-sized windows of words.  The CGK random
walk turns word edit distance into Hamming distance: it copies the word under
a pointer and moves the pointer on or not by a random bit of word and step.
Each repetition draws its own walk and samples a few places of the embedding;
windows and items that agree on them are candidates, and the exact edit
distance decides.  The number of repetitions is raised until edited copies of
the items themselves are found at the target recall.

Only windows that can match are embedded: by the q-gram lemma a copy within
``e`` edits of an item of ``n`` words shares at least n - q + 1 - q e of its
q-word sequences, and a shared one also tells where the window lies.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small


SIMILARITY = 0.8  # least 1 - edits / words of the item
SAMPLED = 3  # places of the embedding that a signature holds
TARGET_RECALL = 0.99
MOST_REPETITIONS = 128
CALIBRATION_ITEMS = 200
BLOCK_WORDS = 200_000  # words of the items that a task holds at a time
GROUP_WORDS = 400_000  # words of documents that are searched at a time

words_in = re.compile(r"\w+").findall

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
        x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
        return x ^ (x >> _U(33))


def edits_allowed(n: int, similarity: float = SIMILARITY) -> int:
    return int((1.0 - similarity) * n + 1e-9)


def _seed_size(n: int, e: int) -> int:
    """Longest q up to 3 for which a copy surely shares a q-gram."""
    return next((q for q in (3, 2) if n - q + 1 - q * e >= 1), 1)


def embed(windows: np.ndarray, lengths: np.ndarray, seeds: np.ndarray, sampled: int) -> np.ndarray:
    """Signatures (window, repetition) of rows of word ids of given lengths."""
    n, widest = windows.shape
    reps = len(seeds)
    out = np.zeros((n, reps), np.uint64)
    padded = np.concatenate([windows, np.zeros((n, 1), windows.dtype)], 1).astype(np.uint64)
    rows = np.arange(n)[:, None]
    steps = 3 * widest
    # the sampled places depend on the repetition and the item's length only
    draw = _mix(seeds[None, :, None] + _U(977) * lengths.astype(np.uint64)[:, None, None]
                + _U(0x51ED2701) * np.arange(1, sampled + 1, dtype=np.uint64)[None, None, :])
    place = (draw % (3 * lengths.astype(np.uint64))[:, None, None]).astype(np.int64)
    at = np.zeros((n, reps), np.int64)
    with np.errstate(over="ignore"):
        for j in range(steps):
            word = padded[rows, np.minimum(at, widest)]
            word[at >= lengths[:, None]] = 0
            for k in range(sampled):
                here = place[:, :, k] == j
                out[here] += _mix(word[here] + _U((k + 1) * 0x9E3779B1))
            at += (_mix(word + seeds[None, :] + _U(j * 0x2545F491)) & _U(1)).astype(np.int64)
        return _mix(out + seeds[None, :] * _U(3) + lengths.astype(np.uint64)[:, None])


def edit_distance_within(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any stretch of ``text``, and where
    the first such stretch ends.

    A column of the table is kept as two bit strings, the places where it
    rises and where it falls (Myers), so a word of the text takes a few steps.
    """
    n = len(item)
    if not n:
        return 0, 0
    places: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    full, last = (1 << n) - 1, 1 << (n - 1)
    rise, fall, now = full, 0, n
    best, end = n, 0
    for j, word in enumerate(text.tolist(), 1):
        same = places.get(word, 0)
        down = same | fall
        across = ((same & rise) + rise ^ rise) | same
        up, less = fall | full & ~(across | rise), rise & across
        if up & last:
            now += 1
        elif less & last:
            now -= 1
            if now < best:
                best, end = now, j
        up <<= 1
        rise = full & (less << 1 | ~(down | up))
        fall = full & up & down
    return best, end


class Block:
    """Some items, their q-grams and signatures."""

    def __init__(self, items: list[list[str]], similarity: float, sampled: int, target: float, seed: int = 1):
        self.items, self.similarity, self.sampled = items, similarity, sampled
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for x in items for w in x}))}
        self.ids = [np.array([self.vocabulary[w] for w in x], np.int64) for x in items]
        self.length = np.array([len(x) for x in items], np.int64)
        self.edits = np.array([edits_allowed(n, similarity) for n in self.length], np.int64)
        self.q = np.array([_seed_size(n, e) for n, e in zip(self.length, self.edits)], np.int64)
        self.seeds_of = {}
        for q in sorted(set(self.q.tolist())):
            entries = {(int(h), len(x), i) for x, mine in zip(self.ids, self.q) if mine == q
                       for i, h in enumerate(self.grams(x, q).tolist())}
            table = np.array(sorted(entries), np.uint64).reshape(-1, 3)
            self.seeds_of[q] = table[:, 0], table[:, 1].astype(np.int64), table[:, 2].astype(np.int64)
        self.seeds = _mix(np.arange(1, MOST_REPETITIONS + 1, dtype=np.uint64) + _U(seed << 32))
        self.seeds, self.recall = self._calibrated(target)
        sig = self.signatures(self.ids)
        flat = sig.ravel()
        order = np.argsort(flat, kind="stable")
        self.sig, self.sig_item = flat[order], order // max(1, sig.shape[1])

    @staticmethod
    def grams(ids: np.ndarray, q: int) -> np.ndarray:
        n = max(0, len(ids) - q + 1)
        out = np.full(n, q, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(q):
                out = _mix(out + ids[k:k + n].astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        return out

    def signatures(self, rows: list[np.ndarray], lengths: np.ndarray | None = None) -> np.ndarray:
        lengths = np.array([len(x) for x in rows], np.int64) if lengths is None else lengths
        out = np.zeros((len(rows), len(self.seeds)), np.uint64)
        order = np.argsort(lengths, kind="stable")
        lo = 0
        while lo < len(order):
            step = max(1, 4_000_000 // (len(self.seeds) * 4 * max(1, int(lengths[order[lo]]))))
            some = order[lo:lo + step]
            widest = int(lengths[some].max())
            table = np.zeros((len(some), widest), np.int64)
            for i, r in enumerate(some):
                x = rows[r][:widest]
                table[i, :len(x)] = x
            out[some] = embed(table, lengths[some], self.seeds, self.sampled)
            lo += step
        return out

    def _calibrated(self, target: float):
        """The fewest repetitions that find items edited as much as is allowed."""
        rng = np.random.default_rng(7)
        picked = [i for i in range(len(self.items)) if self.edits[i] > 0][:CALIBRATION_ITEMS]
        if not picked:
            return self.seeds[:1], 1.0
        edited = []
        for i in picked:
            x = self.ids[i].tolist()
            for _ in range(int(self.edits[i])):
                at, what = int(rng.integers(len(x))), int(rng.integers(3))
                if what == 0:
                    x[at] = 0
                elif what == 1:
                    x.insert(at, 0)
                else:
                    del x[at]
            x = (x + [0] * len(self.ids[i]))[:len(self.ids[i])]
            edited.append(np.array(x, np.int64))
        same = self.signatures(edited) == self.signatures([self.ids[i] for i in picked])
        found = np.maximum.accumulate(same, 1).mean(0)
        enough = int(np.argmax(found >= target)) + 1 if (found >= target).any() else len(self.seeds)
        return self.seeds[:enough], float(found[enough - 1])

    def _windows(self, ids: np.ndarray, doc: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """(start, length) of windows that may hold a copy."""
        starts, lengths = [], []
        for q, (keys, length, offset) in self.seeds_of.items():
            if len(ids) < q:
                continue
            ok = np.ones(len(ids) - q + 1, bool)
            for k in range(q):
                ok &= (ids[k:len(ok) + k] > 0) & (doc[k:len(ok) + k] == doc[:len(ok)])
            at = np.nonzero(ok)[0]
            gram = self.grams_at(ids, at, q)
            lo, hi = np.searchsorted(keys, gram, "left"), np.searchsorted(keys, gram, "right")
            some = hi > lo
            at, lo, hi = at[some], lo[some], hi[some]
            if not len(at):
                continue
            hits = np.zeros(len(ids) + 1, np.int64)
            hits[at + 1] = 1
            hits = np.cumsum(hits)
            for p in range(0, len(at), 200_000):
                n = (hi - lo)[p:p + 200_000]
                entry = np.repeat(lo[p:p + 200_000] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                pos = np.repeat(at[p:p + 200_000], n)
                size, start = length[entry], pos - offset[entry]
                edits = ((1.0 - self.similarity) * size + 1e-9).astype(np.int64)
                low = np.maximum(start - edits, begin[doc[pos]])
                high = np.minimum(start + size + edits, end[doc[pos]]) - q + 1
                enough = hits[np.maximum(high, low)] - hits[low] >= np.maximum(size - q + 1 - q * edits, 1)
                key = np.unique(np.stack([doc[pos], start, size], 1)[enough], axis=0)
                starts.append(key[:, :2])
                lengths.append(key[:, 2])
        if not starts:
            return np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(lengths)

    @staticmethod
    def grams_at(ids: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
        out = np.full(len(at), q, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(q):
                out = _mix(out + ids[at + k].astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        return out

    def search(self, texts: list[list[str]]) -> list[list[tuple[int, int, int, int]]]:
        """For each text its copies: (item, distance, first word, words)."""
        out: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        get = self.vocabulary.get
        sizes = np.array([len(x) for x in texts], np.int64)
        end = np.cumsum(sizes)
        begin = end - sizes
        ids = np.fromiter(map(get, chain.from_iterable(texts), repeat(0)), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(texts)), sizes)
        where, lengths = self._windows(ids, doc, begin, end)
        for lo in range(0, len(where), 4096):
            part, size = where[lo:lo + 4096], lengths[lo:lo + 4096]
            rows = []
            for (d, start), n in zip(part.tolist(), size.tolist()):
                a, b = max(start, begin[d]), min(start + n, end[d])
                row = np.zeros(n, np.int64)
                row[a - start:b - start] = ids[a:b]
                rows.append(row)
            sig = self.signatures(rows, size)
            flat = sig.ravel()
            first, last = np.searchsorted(self.sig, flat, "left"), np.searchsorted(self.sig, flat, "right")
            n = last - first
            entry = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pairs = np.stack([np.repeat(np.arange(len(flat)) // sig.shape[1], n), self.sig_item[entry]], 1)
            for w, item in np.unique(pairs, axis=0).tolist():
                d, start = part[w].tolist()
                if self.length[item] != size[w]:
                    continue
                best = out[d].get(item)
                if best and best[0] == 0:
                    continue
                e = int(self.edits[item])
                a = max(start - e, int(begin[d]))
                text = ids[a:min(start + int(size[w]) + e, int(end[d]))]
                distance, stop = edit_distance_within(self.ids[item], text)
                if distance <= e:
                    _, back = edit_distance_within(self.ids[item][::-1], text[:stop][::-1])
                    found = (distance, a + stop - back - int(begin[d]), back)
                    if best is None or found < best:
                        out[d][item] = found
        return [[(i, *x) for i, x in sorted(found.items())] for found in out]


def _blocks(benchmark: DataFrame, key: str, text: str, block_words: int):
    """Items in blocks of bounded size, each on the driver in its turn."""
    rows = benchmark.select(F.col(key).alias("item_id"), F.col(text).cast("string").alias("t")).filter(F.col("t").isNotNull())
    size = rows.agg(F.sum(F.size(F.split("t", r"\W+"))).alias("n")).first().n or 0
    n = -(-size // block_words)
    for i in range(n):
        block = rows.filter(F.pmod(F.xxhash64("item_id", "t"), F.lit(n)) == i).orderBy("item_id", "t").toArrow()
        names, items = block.column("item_id"), [words_in(t.lower()) for t in block.column("t").to_pylist()]
        some = [k for k, x in enumerate(items) if x]
        if some:
            yield names.take(pa.array(some)).combine_chunks(), [items[k] for k in some]


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  item_key: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY,
                  sampled: int = SAMPLED, target_recall: float = TARGET_RECALL,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``keep`` and ``matches`` for each row: the items that its text holds.

    A match has item_id, distance (word edits), item_words, word_start and
    n_words (the stretch of the text): the closest copy of the item, the first
    of equals.  Words are runs of letters, digits and underscores, lower-cased.
    Null and empty texts match nothing, and no text matches a null or empty
    item.  Items of equal text all match.  Repeated rows stay.
    """
    sc = docs.sparkSession.sparkContext
    item_type = benchmark.schema[item_key].dataType.simpleString()
    match = f"array<struct<item_id: {item_type}, distance: int, item_words: int, word_start: int, n_words: int>>"
    out = docs.select(F.struct(*[F.col(c) for c in keep]).alias("keep"),
                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"),
                      F.expr(f"cast(array() as {match})").alias("matches"))
    kind = out.schema["keep"].dataType.simpleString()
    for names, items in _blocks(benchmark, item_key, item_text, block_words):
        held = sc.broadcast((Block(items, similarity, sampled, target_recall), names))

        def run(batches, held=held):
            block, names = held.value
            struct = pa.struct([("item_id", names.type), *((k, pa.int32()) for k in (
                "distance", "item_words", "word_start", "n_words"))])
            names = names.to_pylist()
            for batch in small(batches, 2048):
                split, group, size = [], [], 0
                for t in batch.column(1).to_pylist():
                    group.append(words_in(t.lower()))
                    size += len(group[-1])
                    if size >= GROUP_WORDS:
                        split += block.search(group)
                        group, size = [], 0
                split += block.search(group) if group else []
                found = [[{"item_id": names[i], "distance": d, "item_words": len(block.items[i]), "word_start": s,
                           "n_words": n} for i, d, s, n in x] for x in split]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.list_(struct))],
                    ["keep", "t", "matches", "found"])

        out = out.mapInArrow(run, f"keep {kind}, t string, matches {match}, found {match}") \
            .select("keep", "t", F.concat("matches", "found").alias("matches"))
    return out.select("keep.*", "matches")


def op2_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item that it holds a copy of."""
    found = contamination(docs, benchmark).select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
    return found.withColumn("similarity", 1.0 - F.col("distance") / F.col("item_words"))
