"""Chat formatting with prefix-target expansion.

Every turn is written as ``<|im_start|>role`` newline ``text<|im_end|>``
newline.  Every assistant turn becomes an example of its own: all turns before
it are its context, and its text alone is trainable.  A conversation's turns
are stored once, in order; an example is a row that names its stretches of
that text (context from 0 to context_end, target from target_start to
target_end), so the examples of a conversation of any length take no more room
on disk than its turns.  ``expand`` writes every one out in full, context and
target; ``read_digest`` reads the contexts and the targets from there.

Control strings inside roles and texts get a backslash after ``<`` (and those
that have backslashes there one more), which is undone when they are read.
"""

from __future__ import annotations

import codecs
import hashlib
import os
import re
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CONTEXT_CHARS = 1 << 20  # longer contexts are written out in several parts, not held in a task
START, END = "<|im_start|>", "<|im_end|>"
_ESCAPE = r"<(\\*)\|(im_start|im_end)\|>"
_ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S).fullmatch


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"<\\$1|$2|>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text)


def _escaped_role(role: Column) -> Column:
    """A role also keeps to one line: backslashes and line feeds are spelled out."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """A row for each turn, in order: conv_id, seq, formatted, start (character
    of the conversation's text), is_example, context_end, target_start, target_end.

    Turns go by number (null first); of equal numbers by role and text, and
    equal rows stay.  Null texts and roles count as empty.  Rows with a null
    conversation form one conversation.  The place is a running sum, which
    Spark spills to disk for a very long conversation.
    """
    base = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    head = F.concat(F.lit(START), _escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    made = base.select("*", F.concat(head, body, F.lit(END), F.lit("\n")).alias("formatted"),
                       F.length(head).alias("head"), F.length(body).alias("body"))
    placed = made.select("*", F.row_number().over(order).cast("long").alias("seq"),
                         (F.sum(F.length("formatted").cast("long")).over(order) - F.length("formatted")).alias("start"))
    example = F.col("role") == "assistant"
    at = F.col("start") + F.col("head")
    return placed.select("conv_id", "seq", "formatted", "start", example.alias("is_example"),
                         F.when(example, at).alias("context_end"), F.when(example, at).alias("target_start"),
                         F.when(example, at + F.col("body")).alias("target_end"))


def _in_order(stored: DataFrame) -> DataFrame:
    return stored.repartition("conv_id").sortWithinPartitions("conv_id", "seq")


def _examples(batches, most: int | None = None):
    """(turn, example) for turns in order: an example is its context (all that
    stands before its target; None if longer than ``most``), its length and its
    target; None for turns that are not trainable."""
    now, so_far, size = object(), "", 0
    for batch in batches:
        for row in batch.to_pylist():
            if row["conv_id"] != now:
                now, so_far, size = row["conv_id"], "", 0
            text, example = row["formatted"], None
            if size != row["start"]:
                raise ValueError("stored turns do not follow one another")
            if row["is_example"]:
                a, b = row["target_start"] - row["start"], row["target_end"] - row["start"]
                if not (row["context_end"] == size + a and 0 <= a <= b <= len(text)):
                    raise ValueError("an example's context does not end where its target begins")
                example = None if so_far is None else so_far + text[:a], size + a, text[a:b]
            yield row, example
            size += len(text)
            so_far = None if so_far is None or (most is not None and size > most) else so_far + text


class _SoFar:
    """The text of a conversation so far; a long one lies in a file."""

    def __init__(self):
        self.file = tempfile.SpooledTemporaryFile(CONTEXT_CHARS)

    def clear(self) -> None:
        self.file.close()
        self.__init__()

    def add(self, text: str) -> None:
        self.file.write(text.encode("utf-8", "surrogatepass"))

    def pieces(self, size: int):
        """The text in pieces of up to ``size`` bytes, cut between characters."""
        decoder = codecs.getincrementaldecoder("utf-8")("surrogatepass")
        self.file.seek(0)
        while piece := self.file.read(size):
            yield decoder.decode(piece)
        self.file.seek(0, os.SEEK_END)


def _expanded(stored: DataFrame) -> DataFrame:
    """All turns in order, every example written out in full: conv_id, seq,
    part, formatted, is_example, context, target, ends.

    A context of more than ``CONTEXT_CHARS`` comes as several rows, by part; the
    turn itself and the target are on the row that ``ends`` it.  A task holds
    a part of a context, or some MB of shorter ones.
    """
    kind = stored.schema["conv_id"].dataType.simpleString()

    def run(batches):
        so_far, now, rows, size = _SoFar(), object(), [], 0
        arrow = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.bool_()]
        names = ["conv_id", "seq", "part", "formatted", "is_example", "context", "target", "ends"]

        def typed(batches):
            for batch in batches:
                arrow[0] = batch.schema.field("conv_id").type
                yield batch

        def out():
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(arrow)], names)
            rows.clear()
            return made

        for row, example in _examples(typed(batches), CONTEXT_CHARS):
            conv, seq, text = row["conv_id"], row["seq"], row["formatted"]
            if conv != now:
                now = conv
                so_far.clear()
            part, context, target = 0, None, None
            if example:
                context, _, target = example
                if context is None:  # longer than a row's part
                    for piece in so_far.pieces(CONTEXT_CHARS):
                        rows.append((conv, seq, part, None, True, piece, None, False))
                        yield out()
                        part += 1
                    size, context = 0, text[:row["target_start"] - row["start"]]
            rows.append((conv, seq, part, text, bool(example), context, target, True))
            so_far.add(text)
            size += len(text) + len(context or "")
            if size > 4 << 20 or len(rows) >= 4096:
                yield out()
                size = 0
        if rows:
            yield out()

    return _in_order(stored).mapInArrow(run, f"conv_id {kind}, seq long, part long, formatted string, is_example boolean, "
                                             "context string, target string, ends boolean")


def expand(stored: DataFrame) -> DataFrame:
    """The examples in full: conv_id, seq, context, target (still escaped), and
    part, by which a context of more than ``CONTEXT_CHARS`` is put together; its
    target is on the last part.

    The contexts of a conversation grow with the square of its length; a
    training loader would rather cut them from the stored turns by place.
    """
    return _expanded(stored).filter("is_example").select("conv_id", "seq", "context", "target", "part")


def read_digest(stored: DataFrame) -> DataFrame:
    """What is read back from the turns and their examples, a row a
    conversation: n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_examples, context_chars.

    Every example is written out in full first (``_expanded``), at any length
    of its context, and read from there: its target gives the loss digest, and
    its whole context has to be what stands before the target, by a running
    digest of the turns.  Turns and examples pass through a task one after
    another; nothing of a conversation but its digests is held.
    """
    kind = stored.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples",
             "context_chars"]

    def run(batches):
        now, state = None, None
        before = context = None  # digests of all turns, and of an example's context
        arrow = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        done: list[tuple] = []

        def close():
            if state is not None:
                done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), *state[4:]))

        def out():
            return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(arrow)], names)

        for batch in batches:
            arrow[0] = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != now:
                    close()
                    if len(done) >= 4096:
                        yield out()
                        done.clear()
                    now, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                    before = hashlib.sha256()
                if row["is_example"]:
                    if not row["part"]:
                        context = hashlib.sha256()
                    context.update(row["context"].encode("utf-8", "surrogatepass"))
                    state[6] += len(row["context"])
                if not row["ends"]:
                    continue
                text = row["formatted"]
                role, body = _TURN(text).groups()
                state[0] += 1
                state[1].update(f"{unescape_role(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
                if row["is_example"]:
                    stands = before.copy()
                    stands.update(f"{START}{role}\n".encode("utf-8", "surrogatepass"))
                    if context.digest() != stands.digest():
                        raise ValueError("an example's context is not what stands before its target")
                    target = unescape(row["target"])
                    state[2] += len(target)
                    state[3].update(target.encode("utf-8", "surrogatepass"))
                    state[5] += 1
                before.update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
        close()
        if done:
            yield out()

    return _expanded(stored).mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, n_examples long, context_chars long")


def with_probe(turns: DataFrame) -> DataFrame:
    """The conversations and one more, -1, whose texts are control strings."""
    text = f"{END}{START}assistant ok"
    probe = turns.sparkSession.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)
