"""Periodic runs of words, by a suffix automaton and link-cut access.

A run is a longest stretch of words with smallest period q whose length is at
least ``max(least, times * q)``.  Appending word i to the text visits the path
from its prefix's state to the root of the suffix-link tree: the suffixes that
end here.  Every state holds the end of its last occurrence; the access cuts
the path into segments of one such end each and recolours all of it with i.  A
segment of previous end p whose deepest state has length l says that the
suffix of l words ended at p last, so with distance d = i - p <= l the words
up to i have period d over l + d words: a square, which reaches l + d - 2d
words further to the left.  No smaller period fits, as the suffix would have
ended later than p, and no longer stretch, as a deeper state would have the
same colour.  It is a run if word i + 1 does not go on with the period.

The tree is final before the accesses start, so its preferred paths are kept
on fixed heavy paths: a recolouring covers the upper end of each heavy path it
passes, and the segments of a heavy path form a stack.  An access costs the
heavy paths on the way (at most the logarithm of the states) and the segments
it takes off, each of which was put there by one access.

The automaton reads only stretches that may hold a run.  In a run of period q
every ``times`` * q or more words long, all five-word sequences after the
first q words have occurred at most q words before; those ends form a stretch
of m >= (times - 1) * q - 4 words, so q <= (m + 4) / (times - 1).  Ends without such an
occurrence are struck out round by round, and what is left, widened to the
left by the longest period it allows, loses no run and cuts none.

Memory of a task: the batch's words, and about 500 bytes a word of the longest
such stretch.
"""

from __future__ import annotations

import hashlib
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small, utf8

LEAST, TIMES = 6, 4
GRAM = 5  # no run has fewer than LEAST = GRAM + 1 words
TOGETHER = 4 << 20  # bytes of text looked at in one go
ROUNDS = 16  # of striking out; more would only make the stretches shorter
_MIX = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Longest length and suffix link of every state (the root is 0), and the
    state of every prefix."""
    length, link, moves, prefix = [0], [-1], [{}], []
    last = 0
    for n, c in enumerate(words, 1):
        cur = len(length)
        length.append(n)
        link.append(0)
        moves.append({})
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                moves.append(dict(moves[q]))
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        prefix.append(cur)
        last = cur
    return length, link, prefix


def heavy_heads(length: list[int], link: list[int]) -> list[int]:
    """The upper end of the heavy path that each state lies on."""
    order = np.argsort(np.array(length), kind="stable").tolist()  # parents first
    size, heavy, best = [1] * len(length), [-1] * len(length), [0] * len(length)
    for v in reversed(order):
        p = link[v]
        if p >= 0:
            size[p] += size[v]
            if size[v] > best[p]:
                best[p], heavy[p] = size[v], v
    head = list(range(len(length)))
    for v in order:
        p = link[v]
        if p >= 0 and heavy[p] == v:
            head[v] = head[p]
    return head


def runs_of(words: list[int], least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs of a sequence, by start, then period."""
    length, link, prefix = suffix_automaton(words)
    head = heavy_heads(length, link)
    stacks: list[list[tuple[int, int]]] = [[] for _ in length]  # (length at the lower end, last end), upper end on top
    n, found = len(words), []
    for i, v in enumerate(prefix):
        while v > 0:
            h, here = head[v], length[v]
            stack = stacks[h]
            covered = 0
            while stack and covered < here:
                low, end = stack[-1]
                if low <= here:
                    stack.pop()
                covered = min(low, here)
                d = i - end
                if covered >= (times - 1) * d and covered + d >= least:
                    start = i + 1 - covered - d
                    goes_on = i + 1 < n and words[i + 1] == words[i + 1 - d]
                    reaches = start > 0 and words[start - 1] == words[start - 1 + d]
                    if not goes_on and not reaches:
                        found.append((start, covered + d, d))
            stack.append((here, i))
            v = link[h]
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(ids: np.ndarray, doc: np.ndarray, times: int = TIMES) -> list[tuple[int, int]]:
    """Stretches [lo, hi) of the words of some documents, one after another,
    that hold all runs whole with the words beside them."""
    n = len(ids)
    if n <= GRAM:
        return []
    key = ids[:n - GRAM + 1].astype(np.uint64)
    for k in range(1, GRAM):
        key = key * _MIX + ids[k:n - GRAM + 1 + k].astype(np.uint64)
        key ^= key >> np.uint64(29)
    inside = doc[:n - GRAM + 1] == doc[GRAM - 1:]
    order = np.argsort(key, kind="stable")
    a, b = order[:-1], order[1:]
    same = (key[a] == key[b]) & (doc[a] == doc[b]) & inside[a] & inside[b]
    back = np.full(n, n, np.int64)  # words back to the same five words, by their end
    back[b[same] + GRAM - 1] = b[same] - a[same]
    at = np.flatnonzero(back < n)
    for rounds_left in reversed(range(ROUNDS)):
        if not len(at):
            return []
        part = np.cumsum((np.diff(at, prepend=-2) != 1) | (np.diff(doc[at], prepend=-1) != 0)) - 1
        m = np.bincount(part)
        longest = (m + GRAM - 1) // (times - 1)
        stays = back[at] <= longest[part]
        if not rounds_left or stays.all():
            break
        at = at[stays]
    first = at[np.flatnonzero(np.diff(part, prepend=-1))]
    last = first + m - 1
    doc_lo = np.searchsorted(doc, doc[first], "left")
    doc_hi = np.searchsorted(doc, doc[first], "right")
    lo = np.maximum(first - longest - GRAM, doc_lo)
    hi = np.minimum(last + 2, doc_hi)
    out: list[tuple[int, int]] = []
    for x, y in zip(lo.tolist(), hi.tolist()):
        if out and x < out[-1][1] and doc[x] == doc[out[-1][0]]:
            out[-1] = (min(x, out[-1][0]), max(y, out[-1][1]))
            while len(out) > 1 and out[-1][0] < out[-2][1] and doc[out[-2][0]] == doc[out[-1][0]]:
                low, high = out.pop()
                out[-1] = (min(low, out[-1][0]), max(high, out[-1][1]))
        else:
            out.append((x, y))
    return out


def runs_of_documents(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """The runs of each of some documents, given as words."""
    sizes = np.array([len(w) for w in texts], np.int64)
    out: list[list[Run]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    ids = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode().indices.to_numpy()
    doc = np.repeat(np.arange(len(texts)), sizes)
    begins = np.cumsum(sizes) - sizes
    for lo, hi in stretches(ids, doc, times):
        k = int(doc[lo])
        shift = lo - int(begins[k])
        out[k] += [(s + shift, size, q) for s, size, q in runs_of(ids[lo:hi].tolist(), least, times)]
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def highest(runs: list[Run]) -> Run | None:
    """The run of greatest exact exponent; ties: smallest start, then period."""
    best = None
    for run in sorted(runs, key=operator.itemgetter(0, 2)):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words left when each run keeps its first period only."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        step[start + period] += 1
        step[start + size] -= 1
    keep = np.cumsum(step[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep)]


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_runs", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("period", T.LongType()),
    T.StructField("exponent_milli", T.LongType()), T.StructField("runs_sha256", T.StringType()),
    T.StructField("collapsed_sha256", T.StringType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")]))),
    T.StructField("collapsed", T.StringType())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str | Column = "text", least: int = LEAST,
                  times: int = TIMES, whole: bool = True) -> DataFrame:
    """One row a row of ``docs``: its id, the runs of its text, the text with
    every run cut down to its first period (words joined by one space; both
    left out unless ``whole``), and their digests.

    Words are separated by ASCII white space.  ``least`` is at least 6 and
    ``times`` at least 4.  Defined results: a null text counts as empty and
    has no words, no run and the digests of empty strings; repeated rows give
    a row each; a null id is kept; an empty table gives an empty one; other
    columns of the input, whatever their names, are not read.
    """
    if least <= GRAM or times < 4:
        raise ValueError("least has to be 6 or more, times 4 or more")
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (utf8(text) if isinstance(text, str) else F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
                       .alias("text"))
    fields = [f for f in FOUND if whole or f.name not in ("runs", "collapsed")]
    names = [f.name for f in fields]

    def rows_of(texts: list[bytes]):
        words = [t.split() for t in texts]
        for ws, runs in zip(words, runs_of_documents(words, least, times)):
            top = highest(runs)
            left = b" ".join(collapsed(ws, runs))
            said = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
            row = {"n_words": len(ws), "n_runs": len(runs), "start": top and top[0], "length": top and top[1],
                   "period": top and top[2], "exponent_milli": top and 1000 * top[1] // top[2],
                   "runs_sha256": hashlib.sha256(said.encode()).hexdigest(),
                   "collapsed_sha256": hashlib.sha256(left).hexdigest()}
            if whole:
                row["runs"] = [dict(zip(("start", "length", "period"), r)) for r in runs]
                row["collapsed"] = left.decode()
            yield row

    arrow = pa.schema([
        (f.name, pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])) if f.name == "runs"
         else pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in fields])

    def find(batches):
        for batch in small(batches):
            column = batch.column("text")
            lo = 0
            while lo < batch.num_rows:
                hi, held = lo, 0
                while hi < batch.num_rows and (hi == lo or held + len(column[hi].as_buffer()) <= TOGETHER):
                    held += len(column[hi].as_buffer())
                    hi += 1
                got = pa.RecordBatch.from_pylist(list(rows_of(column.slice(lo, hi - lo).to_pylist())), arrow)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *got.columns],
                                                 ["doc_id", *names])
                lo = hi

    return rows.mapInArrow(find, T.StructType([rows.schema["doc_id"], *fields]))


def planted(id_col: str, text: str) -> Column:
    """The text in which every tenth document (by the crc32 of its id, null as
    empty) goes on periodically from some word on.  Of the crc32 h and
    g = h div 10: word i >= a becomes word a + (i - a) % p, where a = g % n
    and p = 1 + (n - a) div (3 + g % 8)."""
    h = "crc32(coalesce(cast(`%s` as string), ''))" % id_col
    source = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.regexp_extract_all(source, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def turned(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        g = F.expr(f"{h} div 10")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at(
            ws, (F.when(i < a, i).otherwise(a + (i - a) % p) + 1).cast("int"))), " ")

    # a text of white space alone has no words and stays as it is
    due = (F.expr(f"{h} % 10") == 0) & source.rlike(r"[^\x20\x09-\x0D]")
    # as a lambda's variable the words are found once, not once a word
    return F.when(due, F.element_at(F.transform(F.array(words), turned), 1)).otherwise(source)


def op11_query(docs: DataFrame) -> DataFrame:
    """Runs of every document, a tenth of them made periodic at their end."""
    return periodic_runs(docs, text=planted("doc_id", "text"), whole=False).drop("n_words")
