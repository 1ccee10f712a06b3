"""Toxicity scores after noisy-channel deobfuscation.

A token that may be disguised (leetspeak, marks or spaces between letters,
repeated letters) is a lattice: each observed character may stand for itself
or for letters it resembles, marks and spaces may be dropped, repetitions
folded.  The Viterbi algorithm finds the reading of highest probability under
a character language model of the training vocabulary and the channel's costs.
Marks may also be borders of words.
The restored words are then scored by the words that mark toxic texts.

The model is learned from all labelled rows; its language model counts the
letters of all their words.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import defaultdict
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, cut, ints, small, utf8

LEXICON = 20_000  # words so frequent that they stand for themselves; a rarer one is decoded
HELD_WORDS = 500_000  # words of different texts a task holds before it passes them on
HELD_GRAMS = 1_000_000  # n-grams a task holds before it passes them on
ORDER = 5
LEAST_SUPPORT = 4
SIGMA = 2.0  # standard deviations below a word's share of toxic texts
SURE_SHARE, LIKELY_SHARE = 0.8, 0.5
REJECT_AT = 0.7
KEPT_TOKENS = 200_000
SHORT_TOKEN = 12  # longer tokens are searched letter by letter, to the same result
PIECE = 256  # a path of a longer lattice is kept in pieces of this size

# Letters that a character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "[": "c", "€": "e", "£": "l",
    "¡": "i", "#": "h", "%": "x", "&": "e", "*": "aeiou", "v": "u", "x": "ks",
}
COST_LEET, COST_MASK, COST_DROP, COST_FOLD, COST_SPACE_DROP, COST_LETTER_SWAP = 1.0, 2.0, 0.7, 0.5, 0.3, 4.0
COST_BORDER = 1.0  # of a mark read as the border of two words

# One letter or digit with marks around it, or marks alone, set apart by white space.
_ALONE = r"(?:(?:[^\w\s]|_)*+[^\W_]?+(?:[^\w\s]|_)*+(?<=\S)(?!\S))"
_SPACED = re.compile(rf"(?<!\S){_ALONE}(?:\s++{_ALONE}){{2,}}+")
_DROPPED = re.compile(r"[\W\d_]").match
_PLAIN = re.compile(r"[^\W\d_]+[.,;:!?\"')]*").fullmatch
_REPEAT = re.compile(r"(.)\1").search


def _count_grams(count: dict[str, int], words, order: int) -> None:
    """Adds the character n-grams of (word, number) pairs, each word between spaces."""
    for w, n in words:
        t = f" {w} "
        for i in range(1, len(t)):
            for k in range(min(order - 1, i) + 1):
                gram = t[i - k:i + 1]
                count[gram] = count.get(gram, 0) + n


class Packed:
    """Numbers by text, 16 bytes each: sorted hashes, found by halving."""

    def __init__(self, texts: list[str], values: np.ndarray):
        import xxhash

        for seed in range(1 << 16):  # until no two texts share a hash
            keys = np.fromiter((xxhash.xxh64_intdigest(t, seed) for t in texts), np.uint64, len(texts))
            order = np.argsort(keys)
            keys = keys[order]
            if not (keys[1:] == keys[:-1]).any():
                break
        self.seed = seed
        self.keys, self.values = array("Q", keys.tobytes()), array("q", values[order].astype(np.int64).tobytes())

    def get(self, text: str, default=None):
        import xxhash

        h = xxhash.xxh64_intdigest(text, self.seed)
        at = bisect_left(self.keys, h)
        return self.values[at] if at < len(self.keys) and self.keys[at] == h else default

    def __getitem__(self, text: str) -> int:
        return self.get(text, 0)

    def __contains__(self, text: str) -> bool:
        return self.get(text) is not None


class CharModel:
    """Witten-Bell character n-grams of a vocabulary, each word between spaces."""

    def __init__(self, words: dict[str, int], order: int = ORDER, grams=None):
        """From the words, or from tables of the n-grams' counts and of the
        totals and kinds of what follows each context."""
        self.order = order
        if grams is None:
            count: dict[str, int] = {}
            _count_grams(count, words.items(), order)
            total: dict[str, int] = defaultdict(int)
            kinds: dict[str, int] = defaultdict(int)
            for gram, n in count.items():
                kinds[gram[:-1]] += 1
                total[gram[:-1]] += n
            grams = count, dict(total), dict(kinds)
        self.count, self.total, self.kinds = grams
        self.letters = max(30, self.kinds.get("", 0) + 1)
        self.kept: dict[str, float] = {}
        self.steps: dict[tuple[str, str], tuple[str, float]] = {}

    def __getstate__(self):
        return self.__dict__ | {"kept": {}, "steps": {}}

    def logp(self, context: str, c: str) -> float:
        key = context[1 - self.order:] + c
        got = self.kept.get(key)
        if got is None:
            if len(self.kept) > 200_000:
                self.kept.clear()
            p, ctx = 1.0 / self.letters, key[:-1]
            for k in range(len(ctx) + 1):
                sub = ctx[len(ctx) - k:]
                n = self.total.get(sub)
                if not n:
                    break
                kinds = self.kinds[sub]
                p = (self.count.get(sub + c, 0) + kinds * p) / (n + kinds)
            got = self.kept[key] = math.log(p)
        return got

    def step(self, state: str, c: str) -> tuple[str, float]:
        """The state after a letter, and log p of the letter.  Contexts that were
        never seen tell no more than their ends, so paths meet in those."""
        got = self.steps.get((state, c))
        if got is None:
            if len(self.steps) > 200_000:
                self.steps.clear()
            now = " " if c == " " else (state + c)[1 - self.order:]
            while len(now) > 1 and now not in self.total:
                now = now[1:]
            got = self.steps[state, c] = now, self.logp(state, c)
        return got


@lru_cache(10_000)
def _ways(c: str, before: str) -> list[tuple[str, float]]:
    ways: list[tuple[str, float]] = []
    if c in " \n\t":
        ways = [(" ", COST_DROP), ("", COST_SPACE_DROP)]
    elif c.isalpha():
        ways = [(c, 0.0)] + [(x, COST_LETTER_SWAP) for x in LEET.get(c, "") if len(x) == 1]
    else:
        ways = [("", COST_DROP)] + [(x, COST_MASK if c == "*" else COST_LEET) for x in LEET.get(c, "")]
        if not c.isalnum():
            ways.append((" ", COST_BORDER))
    if c == before and ways[0][0]:
        ways.append(("", COST_FOLD))
    return ways


def readings(observed: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each character what it may stand for, at which cost."""
    return [_ways(c, observed[i - 1] if i else "") for i, c in enumerate(observed)]


def _first(a, b) -> bool:
    """Whether the text of path a sorts before that of path b."""
    (_, x, p), (_, y, q) = a, b
    while p is not q:
        (p, u), (q, v) = p, q
        x, y = u + x, v + y
    return x < y


def decode(observed: str, model: CharModel) -> str:
    """The most probable reading of a lattice (exact Viterbi over its states).

    A path is its value, its text since the last piece border and the chain of
    the texts before, which paths share; the states go on over borders."""
    low = observed.lower()
    states: dict[str, tuple[float, str, tuple | None]] = {" ": (0.0, "", None)}
    for i, c in enumerate(low):
        if i and i % PIECE == 0:
            shared: dict[tuple[int, str], tuple] = {}
            states = {s: (v, "", shared.setdefault((id(chain), text), (chain, text)))
                      for s, (v, text, chain) in states.items()}
        after: dict[str, tuple[float, str, tuple | None]] = {}
        ways = _ways(c, low[i - 1] if i else "")
        for state, (at, text, chain) in states.items():
            for read, cost in ways:
                if not read:
                    now, value, new = state, at - cost, text
                elif read == " " and state[-1] == " ":
                    now, value, new = state, at - cost, text
                else:
                    now, step = model.step(state, read)
                    value, new = at - cost + step, text + read
                old = after.get(now)
                if old is None or value > old[0] or (value == old[0] and _first((value, new, chain), old)):
                    after[now] = value, new, chain
        states = after
    best = None
    for s, (v, text, chain) in states.items():
        end = v + (0.0 if s[-1] == " " else model.logp(s, " ")), text, chain
        if best is None or end[0] > best[0] or (end[0] == best[0] and _first(best, end)):
            best = end
    _, text, chain = best
    parts = [text]
    while chain:
        chain, text = chain
        parts.append(text)
    return "".join(reversed(parts)).strip()


def spelling(words) -> re.Pattern:
    """Matches whatever has a reading with one of ``words`` in it: each letter
    as itself or what stands for it, repeated, with characters that may be
    dropped after it.  What it does not match need not be decoded."""
    def letter(c: str) -> str:
        return "[" + "".join(re.escape(o) for o in [c, *(o for o, ways in LEET.items() if c in ways)]) + r"]+[\W\d_]*"

    return re.compile("|".join("".join(map(letter, w)) for w in sorted(words)) or r"(?!)")


class Spelled:
    """Finds what ``spelling`` finds in one pass however long the token is, where
    the pattern would try every way of dealing a run among a word's letters."""

    def __init__(self, words):
        self.first = self.last = 0
        self.at: dict[str, int] = {}  # the letters, as bits, that a character may stand for
        n = 0
        for w in sorted(words):
            self.first |= 1 << n
            for c in w:
                for o in [c, *(o for o, ways in LEET.items() if c in ways)]:
                    self.at[o] = self.at.get(o, 0) | 1 << n
                n += 1
            self.last |= 1 << (n - 1)

    def search(self, token: str) -> bool:
        letter = tail = 0
        for c in token:
            reached = letter | tail
            letter = (letter | reached << 1 | self.first) & self.at.get(c, 0)
            if letter & self.last:
                return True
            tail = reached if _DROPPED(c) else 0
        return False


def _one_spaced(run: re.Match) -> str:
    return " ".join(run.group().split())


def folded(text: str) -> str:
    return re.sub(r"(.)\1+", r"\1", text)


class Restorer:
    """Restores tokens and texts."""

    def __init__(self, model: CharModel, words: dict[str, int]):
        self.model, self.words = model, words

    def token(self, token: str) -> str:
        """The reading of one lower-cased token."""
        bare = token.strip(".,;:!?\"')(")
        if bare in self.words:
            return bare
        if _PLAIN(token) and not _REPEAT(bare):
            return bare
        if not any(c.isalpha() for c in token) and not any(c in LEET for c in token):
            return token
        return decode(token, self.model)

    def spaced(self, text: str, wanted) -> list[str]:
        """Readings of the ``wanted`` runs of single characters set apart by
        white space."""
        runs = (_one_spaced(m) for m in _SPACED.finditer(text))
        return [decode(run, self.model) for run in runs if wanted(run)]

    def text(self, text: str) -> str:
        """The whole restored text, its white space folded."""
        low = text.lower()
        low = _SPACED.sub(lambda m: decode(_one_spaced(m), self.model), low)
        return " ".join(self.token(t) for t in low.split())


class ToxicModel:
    """What marks toxic texts: log(1 - p) of words, and of a text without any."""

    def __init__(self, weights: dict[str, float], base: float, words: dict[str, int], letters: CharModel | None = None):
        self.weights, self.base, self.words, self.letters = weights, base, words, letters
        self._restorer: Restorer | None = None
        self._of_token: dict[str, tuple[str, ...]] = {}
        self._spelling = spelling(weights)
        self._spelled = Spelled(weights)
        self._folded = re.compile("|".join(sorted(folded(w) for w in weights)) or r"(?!)")

    def __getstate__(self):
        return self.__dict__ | {"_restorer": None, "_of_token": {}}

    def _may_mark(self, token: str) -> bool:
        """Whether any reading of a token holds a toxic word."""
        if token.isalpha() and "v" not in token and "x" not in token:
            return bool(self._folded.search(folded(token)))
        return bool((self._spelling if len(token) <= SHORT_TOKEN else self._spelled).search(token))

    @property
    def restorer(self) -> Restorer:
        if self._restorer is None:
            self._restorer = Restorer(self.letters or CharModel(self.words), self.words)
        return self._restorer

    def marks(self, text: str) -> set[str]:
        """Toxic words of the restored text."""
        low, kept = text.lower(), self._of_token
        if len(kept) > KEPT_TOKENS:
            kept.clear()
        tokens = low.split()
        got = set(map(kept.get, tokens))
        if None in got:
            for t in set(tokens):
                if t not in kept:
                    # words as the learning splits them, and those of the reading
                    read = f"{t} {self.restorer.token(t)}" if self._may_mark(t) else ""
                    kept[t] = tuple({w for w in re.findall(r"[^\W\d_]+", read) if w in self.weights})
            got = set(map(kept.get, tokens))
        found = {w for ws in got for w in ws}
        for read in self.restorer.spaced(low, self._spelled.search):
            found.update(w for w in read.split() if w in self.weights)
        return found

    def score(self, text: str) -> float:
        clean = 1.0 - self.base
        for w in self.marks(text):
            clean *= 1.0 - self.weights[w]
        return min(1.0, max(0.0, 1.0 - clean))


def _least_share(toxic: float, n: float) -> float:
    """Lower end of the Wilson interval of toxic out of n."""
    p, z = toxic / n, SIGMA * SIGMA
    return (p + z / (2 * n) - SIGMA * math.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)


def _labelled_words(rows: DataFrame) -> DataFrame:
    """(sig, toxic, words): the different words of all texts of one ``sig`` and
    label.  Near copies mostly share ``sig``, the smallest hash of their
    five-word shingles, so that they count once, but with all their words."""
    import xxhash

    def batch_of(made, words):
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*made), (pa.int64(), pa.int32(), words))],
                                          ["sig", "toxic", "words"])

    def run(batches):
        held: dict[tuple[int, int], set] = {}
        size = 0
        for batch in small(batches):
            for toxic, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low = value.decode("utf-8", "replace").lower()
                toks = low.split()
                sig = min((xxhash.xxh64_intdigest(" ".join(toks[i:i + 5])) >> 1
                           for i in range(max(1, len(toks) - 4))), default=0)
                group = held.setdefault((sig, toxic), set())
                before = len(group)
                group.update(re.findall(r"[^\W\d_]+", low))
                size += len(group) - before + 1
            if size > HELD_WORDS:
                yield from out(held)
                size = 0
        yield from out(held)

    def out(held):
        made = [(*key, " ".join(sorted(held.pop(key)))) for key in sorted(held)]  # one text is half as large on its way
        for lo in range(0, len(made), 512):
            yield batch_of(made[lo:lo + 512], pa.string())

    def rows_of(batches):
        for batch in small(batches):
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def merge(batches):
        made = []
        for key, group in groupby(rows_of(batches), lambda r: r[:2]):
            made.append((*key, sorted({w for r in group for w in r[2].split()})))
            if len(made) >= 512:
                yield batch_of(made, pa.list_(pa.string()))
                made = []
        if made:
            yield batch_of(made, pa.list_(pa.string()))

    part = rows.select("toxic", "t").mapInArrow(run, "sig long, toxic int, words string")
    return part.repartition("sig", "toxic").sortWithinPartitions("sig", "toxic").mapInArrow(
        merge, "sig long, toxic int, words array<string>")


def _letters(counts: DataFrame) -> CharModel:
    """The character model of all words (w, n).  The driver gets the n-grams
    of up to ``ORDER`` characters, whose number grows far slower than the words'."""

    def count(batches):
        held: dict[str, int] = {}

        def out():
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              ["gram", "n"])
            held.clear()
            return made

        for batch in small(batches):
            _count_grams(held, zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), ORDER)
            if len(held) > HELD_GRAMS:
                yield out()
        if held:
            yield out()

    grams = cut(counts.select("w", "n").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")),
                "toxic-grams")
    got = grams.toArrow()
    after = grams.groupBy(F.expr("left(gram, char_length(gram) - 1)").alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds")).toArrow()
    contexts = after.column("context").to_pylist()
    return CharModel({}, grams=(Packed(got.column("gram").to_pylist(), ints(got.column("n"))),
                                Packed(contexts, ints(after.column("total"))), Packed(contexts, ints(after.column("kinds")))))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
          lexicon: int = LEXICON) -> ToxicModel:
    """A model from all labelled rows.

    Rows with a null key, label or text are not used; of labels that disagree
    the larger holds.  Texts and words are counted by Spark, near copies of one
    label once with all their words; the driver gets the n-grams of the language
    model, which counts all words, the ``lexicon`` most frequent words, which
    need no decoding, and, of the words that mostly stand in toxic texts, which
    sets of them the texts hold and how often.  Words whose share of toxic texts is surely high mark
    them; others are added one after another, each judged on the texts that
    the chosen ones leave unexplained.
    """
    marked = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("toxic")).dropna() \
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).dropna() \
        .join(marked.hint("merge"), "id").select(F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"), utf8("text").alias("t"))
    texts = cut(_labelled_words(rows), "toxic-texts")
    counts = cut(texts.select("toxic", F.explode("words").alias("w")).groupBy("w").agg(
        F.sum("toxic").alias("t"), F.count("*").alias("n")), "toxic-words")
    known = {r.w: int(r.n) for r in counts.orderBy(F.desc("n"), "w").limit(lexicon).collect()}
    z, p, n = SIGMA ** 2, F.col("t") / F.col("n"), F.col("n")
    share = (p + z / (2 * n) - SIGMA * F.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)
    strong = counts.filter((F.col("t") >= LEAST_SUPPORT) & (share > LIKELY_SHARE)).select("w")
    held = [(int(r.t), int(r.n), set(r.words)) for r in
            texts.select("sig", "toxic", F.explode("words").alias("w")).join(F.broadcast(strong), "w")
            .groupBy("sig", "toxic").agg(F.sort_array(F.collect_list("w")).alias("words"))
            .groupBy("words").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).collect()]

    def shares(rows):
        tally: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for t, n, words in rows:
            for w in words:
                tally[w][0] += t
                tally[w][1] += n
        return {w: (_least_share(t, n), t) for w, (t, n) in tally.items() if t >= LEAST_SUPPORT}

    weights = {w: 0.0 for w, (least, _) in shares(held).items() if least > SURE_SHARE}
    while True:
        left = [(t, n, words) for t, n, words in held if not words & weights.keys()]
        least, _, w = max(((*x, w) for w, x in shares(left).items()), default=(0.0, 0, ""))
        if least <= LIKELY_SHARE:
            break
        weights[w] = 0.0
    for w in weights:
        with_w = [(t, n) for t, n, words in held if w in words]
        weights[w] = (sum(t for t, _ in with_w) + 0.5) / (sum(n for _, n in with_w) + 1.0)
    total = texts.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    explained = [(t, n) for t, n, words in held if words & weights.keys()]
    toxic_left = (total.t or 0) - sum(t for t, _ in explained)
    rows_left = total.n - sum(n for _, n in explained)
    base = (toxic_left + 0.5) / (rows_left + 1.0) if rows_left else 0.5
    return ToxicModel(weights, min(base, 0.5), known | {w: max(known.get(w, 1), 1) for w in weights}, _letters(counts))


def score(docs: DataFrame, model: ToxicModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          restored: bool = False) -> DataFrame:
    """``keep``, score and predicted (1 from a score of 0.7) for each row.

    A null text counts as empty and gets the score of a text without toxic
    words.  ``restored`` adds the whole restored text.  Repeated rows stay.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("keep"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))

    def run(batches):
        m = held.value
        for batch in small(batches):
            texts = batch.column(1).to_pylist()
            cols = [batch.column(0), pa.array([m.score(t) for t in texts], pa.float64())]
            names = ["keep", "score"]
            if restored:
                cols.append(pa.array([m.restorer.text(t) for t in texts], pa.string()))
                names.append("restored")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = rows.schema["keep"].dataType.simpleString()
    out = rows.mapInArrow(run, f"keep {kind}, score double" + (", restored string" if restored else ""))
    return out.select("keep.*", "score", (F.col("score") >= REJECT_AT).cast("int").alias("predicted"),
                      *(["restored"] if restored else []))


def op6_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from labels whose crc32 does not leave 1."""
    rows = docs.select("doc_id", "text", (crc_mod("doc_id", 3) == 1).alias("held_out"))
    model = learn(docs, labels.filter(crc_mod("doc_id", 3) != 1))
    return score(rows, model, keep=("doc_id", "held_out"))
