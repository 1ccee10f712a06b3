"""Hierarchical multi-length packing of tokenised documents.

Documents are cut into full windows of the longest tier; what is left of each
is routed to the shortest tier that holds it.  Tiers are packed from long to
short: a window opens with the largest piece of its tier, its gap is filled
with the largest whole pieces of shorter tiers that fit, and only a gap that
no whole piece fits is closed by cutting one.  Every window so ends exactly
full; at the end of a partition at most one window of the longest tier is
left with padding.  Windows are dealt into step groups of equal token counts.

Each Spark partition is packed by itself in one pass with bounded memory, so
there is no shuffle; a lost task repeats its own partition only.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small
from .tokens import encoder

TIERS = (1024, 512, 256, 128)
STEP_WINDOWS = 8  # a step group holds the tokens of so many of the longest windows
END_ID = 0
BUFFER_TOKENS = 1_000_000  # a task packs after so many new tokens


class Packer:
    """Packs pieces (document, start, length) into exactly filled windows."""

    def __init__(self, tiers=TIERS, step_windows: int = STEP_WINDOWS):
        self.tiers = tuple(sorted(tiers, reverse=True))
        self.longest = self.tiers[0]
        self.of_length = [[] for _ in range(self.longest + 1)]
        self.lengths = 0  # bit n is set while a piece of length n waits
        self.waiting = 0
        self.step_tokens = step_windows * self.longest
        self.room: dict[int, int] = {}  # open step groups: tokens that still fit
        self.steps = 0
        self.windows = 0

    def _put(self, piece) -> None:
        self.of_length[piece[2]].append(piece)
        self.lengths |= 1 << piece[2]
        self.waiting += piece[2]

    def _take(self, n: int):
        stack = self.of_length[n]
        piece = stack.pop()
        if not stack:
            self.lengths &= ~(1 << n)
        self.waiting -= n
        return piece

    def _fitting(self, most: int) -> int:
        return (self.lengths & ((1 << (most + 1)) - 1)).bit_length() - 1

    def _window(self, size: int):
        """One window of ``size`` tokens; less only if nothing more waits."""
        gap, pieces = size, []
        while gap and self.waiting:
            n = self._fitting(gap)
            if n > 0:
                piece = self._take(n)
            else:  # every piece is longer than the gap: cut the shortest
                above = self.lengths >> (gap + 1)
                doc, start, length = self._take(gap + 1 + (above & -above).bit_length() - 1)
                self._put((doc, start + gap, length - gap))
                piece = (doc, start, gap)
            pieces.append(piece)
            gap -= piece[2]
        return self._numbered(size, pieces)

    def _numbered(self, size: int, pieces):
        fits = [(room, step) for step, room in self.room.items() if room >= size]
        if fits:
            step = min(fits)[1]
        else:
            step, self.steps = self.steps, self.steps + 1
            self.room[step] = self.step_tokens
        self.room[step] -= size
        if not self.room[step]:
            del self.room[step]
        self.windows += 1
        return self.windows - 1, size, step, pieces

    def add(self, doc, n: int):
        """Full windows of a document of ``n`` tokens; the rest waits."""
        start = 0
        while n - start >= self.longest:
            yield self._numbered(self.longest, [(doc, start, self.longest)])
            start += self.longest
        if n > start:
            self._put((doc, start, n - start))

    def pack(self, end: bool = False):
        """Windows of what waits; at ``end`` nothing stays behind."""
        for i, size in enumerate(self.tiers):
            below = self.tiers[i + 1] if i + 1 < len(self.tiers) else 0
            while self.waiting >= size and self.lengths >> (below + 1):
                yield self._window(size)
        if end:
            while self.waiting:
                yield self._window(next((s for s in self.tiers if s <= self.waiting), self.longest))


_SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "tier int, step_id long")


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str = "byte_bpe_50k.json",
         tiers: tuple[int, ...] = TIERS, step_windows: int = STEP_WINDOWS, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """A row for each piece: its place in its document and in its sequence.

    A null text counts as empty: the end id alone.  Repeated rows are packed
    as documents of their own.  ``with_ids`` adds the ids themselves.
    ``tier`` is the window's length, ``step_id`` its step group.
    """
    schema = docs.select(F.col(key).alias("doc_id")).schema
    out_type = f"doc_id {schema[0].dataType.simpleString()}, {_SCHEMA}" + (", ids array<int>" if with_ids else "")

    def run(batches):
        coder = encoder(tokenizer)
        packer = Packer(tiers, step_windows)
        base = TaskContext.get().partitionId() << 33
        end = end_id.to_bytes(4, "little")

        def rows(windows):
            cols = [[] for _ in range(10)]
            for number, size, step, pieces in windows:
                offset = 0
                for (doc, ids), start, length in pieces:
                    part = ids[4 * start:4 * (start + length)]
                    for col, value in zip(cols, (doc, start, length, zlib.crc32(part), len(ids) // 4, base + number,
                                                 offset, size, base + step, part)):
                        col.append(value)
                    offset += length
            return cols

        def batch_of(cols):
            kinds = [id_type[0], *[pa.int64()] * 6, pa.int32(), pa.int64()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_id"]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype("i4") for x in cols[9]], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        id_type, fresh, held = [pa.int64()], 0, []
        for batch in small(batches):
            id_type[0] = batch.column(0).type
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(texts), 256):
                got = coder.encode(texts[lo:lo + 256])
                for name, ids in zip(names[lo:lo + 256], got):
                    ids += end
                    fresh += len(ids) // 4
                    held += packer.add((name, ids), len(ids) // 4)
                if fresh >= BUFFER_TOKENS:
                    yield batch_of(rows(held + list(packer.pack())))
                    fresh, held = 0, []
        held += packer.pack(end=True)
        if held:
            yield batch_of(rows(held))

    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")) \
        .mapInArrow(run, out_type)
