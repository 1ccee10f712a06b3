"""Token counts of whole texts under a public sentencepiece vocabulary.

Tasks get texts as Arrow batches and return lengths only; no id leaves a
worker.  The library is called with lists of texts of about ``batch_bytes``
together, however many rows that are, so a call's memory is bounded.

A text of more than ``part_bytes`` is cut into parts at safe boundaries.  The
vocabulary's own pieces say where those are: merging only ever joins symbols
into a piece, so two neighbouring characters that stand side by side in no
piece are never joined, and the tokens of a text are those of its two sides
together.  A part after the first is read behind a line feed, which is in no
piece; the two tokens that it makes with the prefix put before every text are
taken off.  A stretch without a safe boundary stays in one part.

A text of more than ``spread_bytes`` is cut once in its own task; its parts
are dealt out by a shuffle, counted wherever they land and summed, so that one
giant text is not one task's work.

Defined results: a null text counts as empty; an empty text has no tokens;
special strings inside texts are ordinary text, as is the library's default;
repeated rows give a row each; a null doc_id is kept; an empty table gives an
empty one; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small
from .tokens import tokenizer_file

MODEL = "piece_bpe_32k.model"
BATCH_BYTES = 1 << 20
PART_BYTES = 1 << 16
SPREAD_BYTES = 1 << 22
SPACE = "▁"  # stands for a space in the vocabulary's pieces
LEAD = "\n"  # in no piece of the vocabulary
ROWS = 10_000  # in a batch that goes through the counter


class TokenCounter:
    """Counts tokens with one sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        model, joined = self.model, set()
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                piece = model.id_to_piece(i)
                joined.update(a + b for a, b in zip(piece, piece[1:]))
        self.joined = joined
        self.lead = len(model.encode(LEAD, num_threads=1))
        # parts need a lead that joins nothing and a model that leaves texts as they are
        probes = ["", "a", " a", "a  b ", "ﬁ 　 é"]
        as_is = all(model.decode(model.encode(p)) == p for p in probes)
        self.cuts = as_is and not any(LEAD in pair for pair in joined) and \
            all(len(model.encode(f"{LEAD} {p}")) - self.lead == len(model.encode(p)) for p in ("a", "the cat", ".x"))

    def safe(self, text: str, i: int) -> bool:
        """Whether no piece can reach over the border before character i."""
        return (text[i - 1] + text[i]).replace(" ", SPACE) not in self.joined

    def parts(self, text: str, size: int) -> Iterator[str]:
        """The text cut at safe borders into parts of at least ``size``
        characters (the last one aside)."""
        lo, n = 0, len(text)
        while self.cuts and n - lo > size:
            hi = lo + size
            while hi < n and not self.safe(text, hi):
                hi += 1
            if hi >= n:
                break
            yield text[lo:hi]
            lo = hi
        yield text[lo:]

    def counts(self, parts: list[tuple[str, bool]]) -> list[int]:
        """Tokens of parts; the flag says whether a part begins its text."""
        got = self.model.encode([t if first else LEAD + t for t, first in parts], num_threads=1)
        return [len(ids) if first else len(ids) - self.lead for ids, (_, first) in zip(got, parts)]


_counters: dict[str, TokenCounter] = {}


def counter(name: str) -> TokenCounter:
    """The worker's counter of a vocabulary file, read once a worker."""
    if name not in _counters:
        _counters.clear()
        _counters[name] = TokenCounter(tokenizer_file(name))
    return _counters[name]


def count_texts(tool: TokenCounter, texts, part: int, together: int) -> list[int]:
    """Token counts of texts, encoded in lists of about ``together`` bytes."""
    out = [0] * len(texts)
    waiting: list[tuple[str, bool]] = []
    owner: list[int] = []
    held = 0

    def flush():
        for at, k in zip(owner, tool.counts(waiting)):
            out[at] += k
        waiting.clear()
        owner.clear()

    for i, text in enumerate(texts):
        if not text:
            continue
        for j, piece in enumerate(tool.parts(text, part) if len(text) > part else (text,)):
            size = len(piece) if piece.isascii() else len(piece.encode())
            if waiting and held + size > together:
                flush()
                held = 0
            waiting.append((piece, j == 0))
            owner.append(i)
            held += size
    if waiting:
        flush()
    return out


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", model: str = MODEL, limit: int = 4096,
                 batch_bytes: int = BATCH_BYTES, part_bytes: int = PART_BYTES,
                 spread_bytes: int = SPREAD_BYTES) -> DataFrame:
    """One row a row of ``docs``: its id, n_bytes, n_tokens, over_limit."""
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    id_type = rows.schema["doc_id"].dataType

    def count(batches):
        tool = counter(model)
        for batch in small(batches, ROWS):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"),
                 pa.array(count_texts(tool, texts, part_bytes, batch_bytes), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    counted = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_bytes", T.LongType()),
                            T.StructField("n_tokens", T.LongType())])
    plain = rows.filter(F.col("n_bytes") <= spread_bytes).mapInArrow(count, counted)

    def cut_up(batches):
        tool = counter(model)
        for batch in small(batches, 1):
            text = batch.column("text")[0].as_py()
            for j, piece in enumerate(tool.parts(text, part_bytes)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("n_bytes"), batch.column("digest"),
                     pa.array([j], pa.int64()), pa.array([piece], pa.string())],
                    ["doc_id", "n_bytes", "digest", "part", "piece"])

    def count_parts(batches):
        tool = counter(model)
        for batch in small(batches, 64):
            first = [j == 0 for j in batch.column("part").to_pylist()]
            got = tool.counts(list(zip(batch.column("piece").to_pylist(), first)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), batch.column("digest"), batch.column("part"),
                 pa.array(got, pa.int64())], ["doc_id", "n_bytes", "digest", "part", "n"])

    key = [T.StructField("doc_id", id_type), T.StructField("n_bytes", T.LongType()),
           T.StructField("digest", T.StringType()), T.StructField("part", T.LongType())]
    giant = rows.filter(F.col("n_bytes") > spread_bytes).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    parts = giant.mapInArrow(cut_up, T.StructType(key + [T.StructField("piece", T.StringType())]))
    # rows alike in id and text give the same parts; their number comes back from the first part
    summed = (parts.repartition("digest", "part")
              .mapInArrow(count_parts, T.StructType(key + [T.StructField("n", T.LongType())]))
              .groupBy("doc_id", "n_bytes", "digest")
              .agg(F.sum("n").alias("n"), F.sum((F.col("part") == 0).cast("long")).alias("copies"))
              .select("doc_id", "n_bytes", F.expr("n div copies").alias("n_tokens"), "copies")
              .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
              .select("doc_id", "n_bytes", "n_tokens"))
    return plain.unionByName(summed).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def op12_query(docs: DataFrame) -> DataFrame:
    """Token counts of ``docs`` under the 32,000 piece vocabulary."""
    return token_counts(docs)
