"""Language identification by Kneser-Ney character models in sorted arrays.

Each language has an interpolated Kneser-Ney model of the characters of its
words, each word between spaces.  The n-grams of all languages lie in one
sorted array of 64-bit hashes per order, with a column of log probabilities
for each language; another array holds the back-off weights of the contexts.
A text gets the language of the lowest cross-entropy per character.  It is
rejected if that lies far above what texts of the language showed in a
calibration part of the sample.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import crc_mod, cut, small

ORDER = 4
SAMPLE_DOCS = 1000  # different labelled texts of a language that a model learns from, at most
CALIBRATION = 10  # one in so many of them calibrates instead
DISCOUNT = 0.75
REJECT_SHARE, REJECT_SLACK, REJECT_LEAST = 0.999, 1.25, 6.0
KEPT_WORDS = 300_000
LONGEST_WORD = 4096  # longer runs of letters are scored in pieces of this size

_WORDS = re.compile(r"[^\W\d_]+").findall
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_in(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    got = _WORDS(text.lower())
    if any(len(w) > LONGEST_WORD for w in got):
        got = [w[i:i + LONGEST_WORD] for w in got for i in range(0, len(w), LONGEST_WORD)]
    return [w for w in got if w.isalpha() or any(map(str.isalpha, w))]


def _hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each place."""
    out = np.full(len(codes), order, np.uint64)
    with np.errstate(over="ignore"):
        for back in range(order - 1, -1, -1):
            shifted = np.zeros(len(codes), np.uint64)
            shifted[back:] = codes[:len(codes) - back] if back else codes
            out = (out + shifted + np.uint64(1)) * _MULT
            out ^= out >> np.uint64(29)
    return out


def _grams(words: list[str], order: int):
    """Code points of all words between spaces, and places in their word."""
    text = "".join(f" {w} " for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    return codes, place, starts, sizes


class CharModels:
    """Models of several languages; see the module's head."""

    def __init__(self, counts: dict[str, dict[str, int]], order: int = ORDER, discount: float = DISCOUNT):
        self.langs = sorted(counts)
        self.order = order
        n_lang = len(self.langs)
        # counts of each order by language: raw for the highest, then continuation counts
        per_lang = []
        for lang in self.langs:
            words, weight = list(counts[lang]), np.array(list(counts[lang].values()), np.float64)
            codes, place, _, sizes = _grams(words, order)
            each = np.repeat(weight, sizes)
            tables: dict[int, tuple] = {}
            h = {k: _hashes(codes, k) for k in range(1, order + 1)}
            # a gram of order k ends at a place k-1 or more characters into its word; shorter ones only at its start
            for k in range(order, 0, -1):
                use = place >= max(1, k - 1)
                whole = (place == k - 1) | (k == order)  # starts with the word's first space, or of the highest order
                key, ctx = h[k][use], None
                if k > 1:
                    shifted = np.concatenate([[np.uint64(0)], h[k - 1][:-1]])
                    ctx = shifted[use]
                raw = whole[use]
                if k < order:  # in the middle of words: count the different characters before
                    longer = np.where(place >= k, h[k + 1], np.uint64(0))[use]
                    pair = np.unique(np.stack([key[~raw], longer[~raw]], 1), axis=0)[:, 0]
                    uniq, first, inv = np.unique(key, return_index=True, return_inverse=True)
                    n = np.bincount(inv[raw], weights=each[use][raw], minlength=len(uniq))
                    n += np.bincount(np.searchsorted(uniq, pair), minlength=len(uniq))
                else:
                    uniq, first, inv = np.unique(key, return_index=True, return_inverse=True)
                    n = np.bincount(inv, weights=each[use], minlength=len(uniq))
                tables[k] = (uniq, n, ctx[first] if ctx is not None else None,
                             h[k - 1][use][first] if k > 1 else None)
            per_lang.append(tables)
        self.keys, self.logp, self.ctx, self.gamma = {}, {}, {}, {}
        alphabet = max(2, len(np.unique(np.concatenate([t[1][0] for t in per_lang]))) + 1) if n_lang else 2
        self.floor = -np.log(alphabet)
        lower_of = {}
        for k in range(1, order + 1):
            keys = np.unique(np.concatenate([t[k][0] for t in per_lang])) if n_lang else np.zeros(0, np.uint64)
            ctx_of = np.zeros(len(keys), np.uint64)
            low_of = np.zeros(len(keys), np.uint64)
            if k > 1:
                for t in per_lang:
                    at = np.searchsorted(keys, t[k][0])
                    ctx_of[at], low_of[at] = t[k][2], t[k][3]
                ctxs = np.unique(ctx_of)
                at_ctx = np.searchsorted(ctxs, ctx_of)
            else:
                ctxs, at_ctx = np.zeros(1, np.uint64), np.zeros(len(keys), np.int64)
            logp = np.zeros((len(keys), n_lang))
            gamma = np.zeros((len(ctxs), n_lang))
            for j, t in enumerate(per_lang):
                at = np.searchsorted(keys, t[k][0])
                n = np.zeros(len(keys))
                n[at] = t[k][1]
                total = np.bincount(at_ctx, weights=n, minlength=len(ctxs))
                kinds = np.bincount(at_ctx, weights=n > 0, minlength=len(ctxs))
                d = np.minimum(discount, 1.0)
                back = np.where(total > 0, d * kinds / np.maximum(total, 1e-9), 1.0)
                back = np.clip(back, 1e-6, 1.0)
                if k > 1:
                    low_at = np.searchsorted(self.keys[k - 1], low_of)
                    low_at[low_at == len(self.keys[k - 1])] = 0
                    have = self.keys[k - 1][low_at] == low_of
                    low = np.where(have, np.exp(self.logp[k - 1][low_at, j]), np.exp(self.floor))
                else:
                    low = np.full(len(keys), np.exp(self.floor))
                seen = total[at_ctx]
                p = np.where(seen > 0, np.maximum(n - d, 0) / np.maximum(seen, 1e-9), 0) + back[at_ctx] * low
                logp[:, j], gamma[:, j] = np.log(p), np.log(back)
            self.keys[k], self.logp[k], self.ctx[k], self.gamma[k] = keys, logp, ctxs, gamma
            lower_of[k] = low_of

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray):
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return at, (keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool))

    def word_scores(self, words: list[str]):
        """Natural log probability of each word by language, and its characters."""
        codes, place, starts, sizes = _grams(words, self.order)
        n_lang = len(self.langs)
        lp = np.full((len(codes), n_lang), self.floor)
        before = None
        for k in range(1, self.order + 1):
            h = _hashes(codes, k)
            use = np.nonzero(place >= max(1, k - 1))[0]
            at, hit = self._find(self.keys[k], h[use])
            lp[use[hit]] = self.logp[k][at[hit]]
            miss = use[~hit]
            if k > 1 and len(miss):
                at, hit = self._find(self.ctx[k], before[miss - 1])
                lp[miss[hit]] += self.gamma[k][at[hit]]
            elif len(miss):
                lp[miss] += self.gamma[k][0]
            before = h
        lp[place == 0] = 0.0
        return np.add.reduceat(lp, starts, axis=0) if len(words) else np.zeros((0, n_lang)), sizes - 1


class Scorer:
    """Scores texts; keeps the scores of the words it has met."""

    def __init__(self, models: CharModels):
        self.models = models
        self._clear()

    def _clear(self):
        self.row: dict[str, int] = {}
        self.lp = np.zeros((1 << 14, len(self.models.langs)))
        self.size = np.zeros(1 << 14, np.int64)

    def texts(self, texts: list[str]):
        """(log probability by language, characters) of each text."""
        if len(self.row) > KEPT_WORDS:
            self._clear()
        split = [words_in(t) for t in texts]
        row = self.row
        new = list({w for ws in split for w in ws if w not in row})
        if new:
            base = len(row)
            while base + len(new) > len(self.size):
                self.lp = np.concatenate([self.lp, np.zeros_like(self.lp)])
                self.size = np.concatenate([self.size, np.zeros_like(self.size)])
            row.update(zip(new, range(base, base + len(new))))
            for lo in range(0, len(new), 20_000):
                hi = min(lo + 20_000, len(new))
                self.lp[base + lo:base + hi], self.size[base + lo:base + hi] = self.models.word_scores(new[lo:hi])
        out, n = np.zeros((len(texts), self.lp.shape[1])), np.zeros(len(texts), np.int64)
        for i, ws in enumerate(split):
            at = np.fromiter(map(row.__getitem__, ws), np.int64, len(ws))
            out[i], n[i] = self.lp[at].sum(0), self.size[at].sum()
        return out, n


class Identifier:
    """Models with their calibration."""

    def __init__(self, models: CharModels, texts: list[tuple[str, str]]):
        self.models = models
        n_lang = len(models.langs)
        self.mean, self.var_doc, self.var_char = np.zeros(n_lang), np.full(n_lang, 0.01), np.full(n_lang, 4.0)
        self.limit = np.inf
        if not texts or not n_lang:
            return
        scorer = Scorer(models)
        lp, n = scorer.texts([t for _, t in texts])
        own = np.array([models.langs.index(lang) for lang, _ in texts])
        some = n > 0
        h = -lp[np.arange(len(own)), own][some] / n[some]
        own, n = own[some], n[some]
        for j in range(n_lang):
            mine = own == j
            if mine.sum() >= 5:
                self.mean[j] = np.median(h[mine])
                off = (h[mine] - self.mean[j]) ** 2
                long = n[mine] >= np.median(n[mine])
                self.var_doc[j] = max(float(np.mean(off[long])), 1e-4)
                self.var_char[j] = max(float(np.median(off * n[mine])), 1.0)
            else:
                self.mean[j] = h.mean() if len(h) else 0.0
        if len(h):
            z = (h - self.mean[own]) / np.sqrt(self.var_doc[own] + self.var_char[own] / n)
            self.limit = max(REJECT_LEAST, REJECT_SLACK * float(np.quantile(z, REJECT_SHARE)))

    def judge(self, lp: np.ndarray, n: np.ndarray):
        """Language (-1: none), confidence, cross-entropy and rejection of texts."""
        if not lp.shape[1]:
            return np.full(len(n), -1), np.zeros(len(n)), np.zeros(len(n)), np.ones(len(n), bool)
        h = -lp / np.maximum(n, 1)[:, None]
        best = h.argmin(1)
        least = h[np.arange(len(n)), best]
        score = 1.0 / np.exp((least[:, None] - h) * np.minimum(n, 100)[:, None]).sum(1)
        z = (least - self.mean[best]) / np.sqrt(self.var_doc[best] + self.var_char[best] / np.maximum(n, 1))
        none = n == 0
        return (np.where(none, -1, best), np.where(none, 0.0, score), np.where(none, 0.0, least),
                none | (z > self.limit))


def learn(train: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS,
          order: int = ORDER) -> Identifier:
    """Models from at most ``sample_docs`` different whole texts of each language.

    The sample is the texts of smallest hash, so it does not depend on how the
    rows are dealt out.  Rows without text or language are not used.
    """
    rows = train.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("t")) \
        .filter(F.col("lang").isNotNull() & F.col("t").isNotNull()).withColumn("h", F.xxhash64("t"))
    first = Window.partitionBy("lang").orderBy("h")
    # only hashes are ranked, and each task passes on no more than the limit of each language
    least = rows.select("lang", "h").distinct().withColumn("r", F.row_number().over(first)).filter(F.col("r") <= sample_docs)
    limit = least.groupBy("lang").agg(F.max("h").alias("most"))  # a row a language, as the model itself has a column
    sample = cut(rows.join(F.broadcast(limit), "lang").filter(F.col("h") <= F.col("most")).drop("most")
                 .dropDuplicates(["lang", "h"]), "langid-sample")
    calibrates = F.pmod(F.col("h"), F.lit(CALIBRATION)) == 0
    # of a language with few texts all serve both ends
    few = sample.groupBy("lang").agg(F.count("*").alias("n"))
    marked = sample.join(F.broadcast(few), "lang").withColumn("calibrates", calibrates & (F.col("n") >= 50))

    def count(batches):
        held: dict[str, Counter] = {}
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(name, Counter()).update(words_in(value))
        for name, words in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(words), pa.string()), pa.array(list(words), pa.string()),
                 pa.array(list(words.values()), pa.int64())], ["lang", "w", "n"])

    counted = marked.filter(~F.col("calibrates")).select("lang", "t").mapInArrow(count, "lang string, w string, n long")
    words = counted.groupBy("lang", "w").agg(F.sum("n").alias("n")).toArrow()  # words of the sample, at most
    counts: dict[str, dict[str, int]] = {}
    for name, w, n in zip(*(words.column(c).to_pylist() for c in ("lang", "w", "n"))):
        counts.setdefault(name, {})[w] = n
    check = marked.filter(F.col("calibrates") | (F.col("n") < 50)).select("lang", "t").toArrow()
    pairs = sorted(p for p in zip(check.column("lang").to_pylist(), check.column("t").to_pylist()) if p[0] in counts)
    return Identifier(CharModels(counts, order), pairs)


def identify(docs: DataFrame, model: Identifier, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and lang_pred, score, cross_entropy, rejected for each row.

    A null text, or one without a letter, is ``und`` with score 0 and rejected;
    so is every text if the model knows no language.  Ties go to the language
    first in order.  Repeated rows stay.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("keep"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))

    def run(batches):
        m = held.value
        scorer = Scorer(m.models)
        names = np.array([*m.models.langs, "und"], object)
        for part in small(batches, 256):
            best, score, h, out = m.judge(*scorer.texts(part.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(h), pa.array(out)],
                ["keep", "lang_pred", "score", "cross_entropy", "rejected"])

    kind = rows.schema["keep"].dataType.simpleString()
    return rows.mapInArrow(run, f"keep {kind}, lang_pred string, score double, cross_entropy double, rejected boolean") \
        .select("keep.*", "lang_pred", "score", "cross_entropy", "rejected")


def op9_query(docs: DataFrame) -> DataFrame:
    """Languages of all documents, learned from those whose crc32 leaves no 0."""
    rows = docs.select("doc_id", "text", "lang", (crc_mod("doc_id", 5) == 0).alias("held_out"))
    return identify(rows, learn(rows.filter(~F.col("held_out"))), keep=("doc_id", "held_out"))
