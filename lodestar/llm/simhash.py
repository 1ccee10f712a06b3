"""SimHash near-duplicates by multi-index hashing.

A fingerprint's 64 bits are three segments.  Of two fingerprints that differ
in at most four bits, at least one segment differs in at most one, so each
fingerprint is filed under its own three segment values and looked up under
all values within one bit of them; matches are verified on all 64 bits.

Equal fingerprints are one node, so copies cost nothing.  Large groups of near
copies are first joined through pivots: in each segment's bucket the
fingerprint with the most documents (then one chosen by hash) is compared with
all others, which is linear in the bucket.  The full look-up then only has to
return links between fingerprints that the pivots have not yet connected, so
it loses no link between components and makes no square of a dense group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small, utf8
from .components import components

SHINGLE = 4
DISTANCE = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
PIVOT_ROUNDS = 3
BLOCK = 4096  # shingle hashes whose bits are summed at a time


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text: a bit is set if over half of the hashes of
    its word shingles have it; a text without words has none set."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*[tokens[i:] for i in range(words)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[lo:lo + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(((2 * ones > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, text: str, keep: tuple[str, ...], words: int) -> DataFrame:
    """(keep, fp as long) for each row; a null text counts as empty."""
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("keep"), utf8(text).alias("t"))

    def run(batches):
        for batch in small(batches):
            got = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], ["keep", "fp"])

    return rows.mapInArrow(run, f"keep {rows.schema['keep'].dataType.simpleString()}, fp long")


def _differ(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _segment(column, i: int):
    at, bits = SEGMENTS[i]
    return F.shiftrightunsigned(column, at).bitwiseAND(F.lit((1 << bits) - 1))


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Nodes whose labels are joined by ``links`` (a, b) between labels."""
    found = components(links).withColumnRenamed("node", "label")
    joined = nodes.join(found, "label", "left")
    return cut(joined.withColumn("label", F.coalesce("component", "label")).drop("component"), "simhash-nodes")


def _pivot_edges(nodes: DataFrame, distance: int, turn: int) -> DataFrame:
    """Links of labels to that of the pivot of each of their fingerprints' buckets."""
    weight = F.col("n") if turn == 0 else F.xxhash64("fp", F.lit(turn))
    filed = nodes.select("fp", "label", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), _segment(F.col("fp"), i).alias("v")) for i in range(3)])).alias("s"),
        weight.alias("weight"))
    pivot = filed.groupBy("s").agg(F.max(F.struct("weight", "fp", "label")).alias("p")).select(
        "s", F.col("p.fp").alias("pivot"), F.col("p.label").alias("pivot_label"))
    near = (F.col("label") != F.col("pivot_label")) & (_differ("fp", "pivot") <= distance)
    return filed.join(pivot, "s").filter(near).select(F.col("label").alias("a"), F.col("pivot_label").alias("b"))


def link(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, label): connected classes of distinct fingerprints ``nodes`` (fp, n)."""
    if not 0 <= distance < 2 * len(SEGMENTS):
        raise ValueError("the segments' balls of one bit reach 5 differing bits at most")
    nodes = cut(nodes.withColumn("label", F.col("fp")), "simhash-nodes")
    for turn in range(PIVOT_ROUNDS):
        nodes = _labelled(nodes, _pivot_edges(nodes, distance, turn))

    # the whole look-up: own segment values against all values within one bit
    own = [F.struct(F.lit(i).alias("i"), _segment(F.col("fp"), i).alias("v")) for i in range(3)]
    ball = [F.struct(F.lit(i).alias("i"), _segment(F.col("fp"), i).bitwiseXOR(F.lit(flip)).alias("v"))
            for i, (_, bits) in enumerate(SEGMENTS) for flip in [0, *(1 << k for k in range(bits))]]
    filed = nodes.select(F.col("fp").alias("a"), F.col("label").alias("label_a"), F.explode(F.array(*own)).alias("s"))
    asked = nodes.select(F.col("fp").alias("b"), F.col("label").alias("label_b"), F.explode(F.array(*ball)).alias("s"))
    found = filed.select("a", "label_a", "s.*").join(
        asked.select("b", "label_b", "s.*").hint("merge"),
        ["i", "v"]).filter((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b"))
                           & (_differ("a", "b") <= distance))
    return _labelled(nodes, found.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))


def groups(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), words: int = SHINGLE,
           distance: int = DISTANCE) -> DataFrame:
    """(keep, fp, label) for each row: rows share a label if links of at most
    ``distance`` differing bits connect them."""
    prints = cut(fingerprints(docs, text, keep, words), "simhash-prints")
    nodes = link(prints.groupBy("fp").agg(F.count("*").alias("n")), distance)
    return prints.join(nodes.select("fp", "label"), "fp").select("keep", "fp", "label")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for each row.

    component_id is the smallest key among all documents reachable by links of
    at most ``distance`` differing bits.  Null keys never become a component's
    id unless all its keys are null.  Texts without words share fingerprint
    zero, linked like any other.  Repeated rows stay.
    """
    rows = groups(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text", ("doc_id",), words, distance)
    rows = rows.select("keep.doc_id", "fp", "label")
    least = rows.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "label").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE,
                distance: int = DISTANCE) -> DataFrame:
    """One row of each group of near duplicates, with its columns: the one of
    smallest key (null last), of equal keys that of smallest hash."""
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.col(text).alias("text"),
                       F.xxhash64(F.to_json(F.struct("*"))).alias("hash"))
    best = F.struct(F.col("keep.key").isNull().alias("none"), "keep.key", "keep.hash")
    kept = groups(rows, "text", ("key", "hash"), words, distance).groupBy("label").agg(F.min(best).alias("best"))
    kept = kept.select(F.col("best.key").alias("kept_key"), F.col("best.hash").alias("kept_hash"))
    same = F.col("key").eqNullSafe(F.col("kept_key")) & (F.col("hash") == F.col("kept_hash"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["key", "hash"]).select("row.*")
