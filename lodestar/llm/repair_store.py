"""Token ids in shards compressed by a Re-Pair grammar.

Documents are written in ascending id order.  Each shard holds about
``SHARD_IDS`` ids: their grammar (frequent pairs of symbols replaced, round
after round, by nonterminals), the expansion length of every rule, the
sequence of symbols that is left and an index of its documents.  A range of a
shard's ids is decoded without expanding the rest.

A shard is one row of a Parquet file, so any store that Spark can write will
do and a lost task leaves nothing half written.  Layout of ``shard``, all
numbers little-endian: magic ``RPG1``; u32 first rule symbol, u32 rules,
u32 symbols, u32 bytes of a symbol (2 or 4); rules as pairs of u32; their
expansion lengths as u32; the symbols.
"""

from __future__ import annotations

import struct
import zlib
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ints, small
from .tokens import encoder

SHARD_IDS = 1 << 20
TEXT_BYTES = 8 << 20  # of texts encoded together
RULES_A_ROUND = 4000
LEAST = 8  # occurrences that make a pair worth a rule
END_ID = 2
MAGIC = b"RPG1"


def _chosen(left: np.ndarray, right: np.ndarray, counts: np.ndarray, most: int) -> list[int]:
    """Frequent pairs, the most frequent first, that never overlap in a text:
    a symbol is only ever the left or only the right of chosen pairs."""
    role: dict[int, str] = {}
    out = []
    order = np.argsort(-counts, kind="stable")[:most]
    for i, a, b in zip(order.tolist(), left[order].tolist(), right[order].tolist()):
        if a == b:
            if a not in role:
                role[a] = "both"
                out.append(i)
        elif role.get(a, "left") == "left" and role.get(b, "right") == "right":
            role[a], role[b] = "left", "right"
            out.append(i)
    return out


def compress(ids: np.ndarray, rounds: int | None = None, least: int = LEAST) -> bytes:
    """The grammar of one shard, as laid out above: ``rounds`` of replacement, or
    as many as it takes until no pair occurs ``least`` times."""
    first = int(ids.max()) + 1 if len(ids) else 0
    x = ids
    rules: list[np.ndarray] = []
    n_rules = 0
    for _ in count() if rounds is None else range(rounds):
        if len(x) < 2:
            break
        narrow = first + n_rules + RULES_A_ROUND <= 1 << 16
        symbol, pair, bits = (np.uint16, np.uint32, 16) if narrow else (np.uint32, np.uint64, 32)
        x = x.astype(symbol, copy=n_rules == 0)
        pairs = x[:-1].astype(pair) << pair(bits)
        pairs |= x[1:]
        pairs.sort()
        many = pairs[least - 1:] == pairs[:max(len(pairs) - least + 1, 0)]
        new = np.ones(len(pairs) + 1, bool)
        np.not_equal(pairs[1:], pairs[:-1], out=new[1:-1])
        begins = np.flatnonzero(many & new[:len(many)])
        counts = np.flatnonzero(many & new[least:]) + least - begins
        pairs = pairs[begins]
        picked = np.sort(pairs[_chosen(pairs >> pair(bits), pairs & pair((1 << bits) - 1), counts, RULES_A_ROUND)])
        if not len(picked):
            break
        symbols = first + n_rules
        rule = np.stack([picked >> pair(bits), picked & pair((1 << bits) - 1)], 1).astype(np.int64)
        # rows for the left symbols of rules, columns for the right ones, and the rule, all from 1
        (lefts, row), (rights, column) = (np.unique(side, return_inverse=True) for side in rule.T)
        left, right = np.zeros(symbols, np.uint16), np.zeros(symbols, np.uint16)
        left[lefts], right[rights] = np.arange(1, len(lefts) + 1), np.arange(1, len(rights) + 1)
        of_pair = np.zeros((len(lefts) + 1, len(rights) + 1), np.uint16)
        of_pair[row + 1, column + 1] = np.arange(1, len(picked) + 1)
        rows, columns = left.take(x[:-1]), right.take(x[1:])
        at = np.flatnonzero((rows != 0) & (columns != 0))
        found = of_pair[rows[at], columns[at]]
        hit = found != 0
        at, found = at[hit], found[hit].astype(np.int64) - 1
        # in a run of one symbol every second place is taken
        same = x[at] == x[at + 1]
        if same.any():
            place = at[same]
            begins = np.concatenate([[True], np.diff(place) != 1])
            run = place - np.maximum.accumulate(np.where(begins, place, 0))
            keep = np.ones(len(at), bool)
            keep[same] = run % 2 == 0
            at, found = at[keep], found[keep]
        x[at] = (symbols + found).astype(symbol)
        stay = np.ones(len(x), bool)
        stay[at + 1] = False
        x = x[stay]
        rules.append(rule)
        n_rules += len(picked)
    table = (np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)).astype("<u4")
    size = 2 if first + n_rules <= 65536 else 4
    lengths = _lengths(first, table)
    return (MAGIC + struct.pack("<IIII", first, n_rules, len(x), size) + table.tobytes()
            + lengths.astype("<u4").tobytes() + x.astype(f"<u{size}").tobytes())


def _lengths(first: int, table: np.ndarray) -> np.ndarray:
    out = [1] * len(table)
    for i, (a, b) in enumerate(table.tolist()):
        out[i] = (out[a - first] if a >= first else 1) + (out[b - first] if b >= first else 1)
    return np.array(out, np.int64)


class Shard:
    """Reads one compressed shard."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a shard of this format")
        self.first, n_rules, n, size = struct.unpack_from("<IIII", blob, 4)
        at = 20
        self.rules = np.frombuffer(blob, "<u4", 2 * n_rules, at).reshape(-1, 2).astype(np.int64)
        at += 8 * n_rules
        self.lengths = np.frombuffer(blob, "<u4", n_rules, at).astype(np.int64)
        at += 4 * n_rules
        self.symbols = np.frombuffer(blob, f"<u{size}", n, at).astype(np.int64)
        each = np.ones(n, np.int64)
        rule = self.symbols >= self.first
        each[rule] = self.lengths[self.symbols[rule] - self.first]
        self.each, self.ends = each, np.cumsum(each)
        self._flat: np.ndarray | None = None

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def _expansions(self):
        """Plain ids, then the expansion of each rule; where each begins."""
        if self._flat is None:
            first, done = self.first, []
            for a, b in self.rules.tolist():
                done.append((done[a - first] if a >= first else (a,)) + (done[b - first] if b >= first else (b,)))
            flat = np.fromiter(chain.from_iterable(done), np.int64, int(self.lengths.sum()))
            self._flat = np.concatenate([np.arange(first), flat])
            ends = np.cumsum(self.lengths)
            self._begin = np.concatenate([np.arange(first), first + ends - self.lengths])
        return self._flat, self._begin

    def decode(self, start: int = 0, length: int | None = None) -> np.ndarray:
        """The ids [start, start + length); expands only the symbols there."""
        stop = len(self) if length is None else min(len(self), start + length)
        if start >= stop:
            return np.zeros(0, np.int64)
        lo = int(np.searchsorted(self.ends, start, "right"))
        hi = int(np.searchsorted(self.ends, stop, "left")) + 1
        flat, begin = self._expansions()
        each, ends = self.each[lo:hi], self.ends[lo:hi]
        before = int(ends[0] - each[0])
        shift = begin[self.symbols[lo:hi]] - (ends - each - before)
        x = flat[np.repeat(shift, each) + np.arange(int(ends[-1]) - before)]
        return x[start - before:stop - before]


def write_ids(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id",
              tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID, shard_ids: int = SHARD_IDS,
              partitions: int | None = None) -> None:
    """Write the ids of all texts to ``path`` in ascending order of ``key``.

    A null text counts as empty: the end id alone.  Null keys come first;
    repeated keys stand in the order of their texts' hash.
    """
    order = [F.col("doc_id"), F.xxhash64("t")]
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    dealt = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        names, coded, size, start = [], [], 0, 0
        kind = pa.int64()

        def shard():
            ids = np.frombuffer(b"".join(coded), "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([names], pa.list_(kind)), pa.array([[len(x) // 4 for x in coded]], pa.list_(pa.int32())),
                 pa.array([compress(ids)], pa.binary())], ["part", "start", "n_ids", "doc_id", "n_tokens", "shard"])

        for batch in small(batches, 2560):
            kind = batch.column(0).type
            ends = np.cumsum(ints(pc.binary_length(batch.column(1))).astype(np.int64))
            lo = 0
            while lo < len(ends):  # many texts at once, but of bounded size
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TEXT_BYTES, "right")))
                keys, texts = (c.slice(lo, hi - lo).to_pylist() for c in batch.columns)
                lo = hi
                for name, ids in zip(keys, coder.encode(texts)):
                    names.append(name)
                    coded.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= shard_ids:
                        yield shard()
                        start += size
                        names, coded, size = [], [], 0
        if names:
            yield shard()

    dealt.sortWithinPartitions(*order).mapInArrow(
        run, f"part int, start long, n_ids long, doc_id array<{id_type}>, n_tokens array<int>, shard binary"
    ).write.parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents read back from the files: their place, length and checksum.

    ``start`` counts the ids of all documents before.  Only the number of ids
    of each written partition passes through the driver.
    """
    shards = spark.read.parquet(path)
    before, offsets = 0, {}
    for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        offsets[r.part] = before
        before += r.n
    id_type = shards.schema["doc_id"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column("shard")[i].as_py())
                n = ints(batch.column("n_tokens")[i].values).astype(np.int64)
                ends = np.cumsum(n)
                base = offsets[batch.column("part")[i].as_py()] + batch.column("start")[i].as_py()
                raw = shard.decode().astype("<u4").tobytes()
                cut = [raw[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), n.tolist())]
                cols = [batch.column("doc_id")[i].values, pa.array(base + ends - n, pa.int64()), pa.array(n, pa.int64()),
                        pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(c, "<i4") for c in cut], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return shards.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long"
                             + (", ids array<int>" if with_ids else ""))
