"""Exact token ids of whole texts from a public tokenizer file.

Both public vocabularies used here split a text into words before merging, and
no word reaches from a visible character into white space, or from a letter or
digit into a mark.  So the ids of a text are the ids of its pieces put
together, and a worker keeps the ids of the pieces it has met.  The ids of a
piece always come from the tokenizers library.  Texts with white space other
than space and line feed go to the library whole; texts with characters from
U+0300 on, where normal forms may join neighbours, or with U+0130, whose lower
case is such a pair, are cut at white space only.

Two cuts need no pattern: where a vocabulary ignores case and white space, the
lower-cased words; else, without two white space characters in a row (whose
ids hang together), each word with the one before it.  Arrow makes these cuts
and finds the distinct words of all texts given, so that Python meets each once.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_AT_SPACE = re.compile(r"[ \n]*[^ \n]+|[ \n]+").findall
_AT_SPACE_AND_MARKS = re.compile(r"[ \n]*[^\W_]+|[ \n]*[^ \n]+|[ \n]+").findall
_OTHER_SPACE = re.compile(r"[^\S \n]").search
_MAY_JOIN = re.compile("[\u0130\u0300-\U0010ffff]").search
_ODD_ASCII_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
# marks after which no vocabulary looks back: all of ASCII but the apostrophe
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = "[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u02c1]+"
_WORD = re.compile(f"( ?)({_LETTERS}|[" + re.escape(_MARKS) + "]+)").fullmatch
KEPT_PIECES = 500_000  # in each of two generations
KEPT_LENGTH = 48
PARTS = 3  # of a piece: line feed, word, marks
TOGETHER = 1024  # new pieces that go to the library in one text


class PieceEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids (as bytes)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        # an added token is cut out before all else, so pieces on its two sides do not touch
        self.between_id, between = min(((i, t) for i, t in added.items() if t.special and not (
            t.lstrip or t.rstrip or t.single_word or t.normalized)), default=(None, None), key=lambda x: x[0])
        self.between = between.content if between else None
        kinds = json.dumps(json.loads(self.tokenizer.to_str())["normalizer"] or {})
        self.folds = self.tokenizer.model.end_of_word_suffix is not None and '"Lowercase"' in kinds
        self.model = self.tokenizer.model
        # bytes as the characters that stand for them in both vocabularies
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        as_char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*shown}))}
        self.in_bytes = {c: "".join(as_char[b] for b in chr(c).encode()) for c in range(0x80, 0x300)}
        self.space = "" if self.folds else as_char[32]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _cut(self, text: str) -> str | list[str] | None:
        """A text whose pieces ``_split`` parts, or the pieces themselves; None
        if it has to be encoded whole."""
        plain = text.isascii()
        if any(c in text for c in _ODD_ASCII_SPACE) if plain else _OTHER_SPACE(text):
            return None
        joins = not plain and _MAY_JOIN(text)
        if self.folds and not joins and "<|" not in text:
            return text.lower()
        feeds = "\n" in text
        if "  " in text or "\0" in text or feeds and ("\n\n" in text or " \n" in text or "\n " in text):
            return (_AT_SPACE if joins else _AT_SPACE_AND_MARKS)(text)
        text = text.replace(" ", "\0 ")
        text = text.replace("\n", "\0\n") if feeds else text
        return text.split("\0") if self.folds else text

    def _split(self, texts: pa.Array) -> pa.Array:
        return pc.ascii_split_whitespace(texts) if self.folds else pc.split_pattern(texts, "\0")

    @staticmethod
    def _parts(pieces: pa.Array) -> pa.Array:
        """Line feed, word and marks of each piece, where it is letters with a
        line feed before or marks after them; else nothing, the piece, nothing."""
        n = len(pieces)
        begin = np.frombuffer(pieces.buffers()[1] or bytes(8), np.int64)[pieces.offset:pieces.offset + n + 1]
        stems = pc.ascii_rtrim(pieces, characters=_MARKS)
        length = pc.binary_length(stems).to_numpy()
        feed = pc.starts_with(pieces, "\n").to_numpy(zero_copy_only=False)
        odd = np.flatnonzero((length < np.diff(begin)) & (length > 0) | feed)
        odd = odd[pc.match_substring_regex(stems.take(pa.array(odd)), f"^\n? ?{_LETTERS}$").to_numpy(zero_copy_only=False)]
        cuts = np.empty(PARTS * n + 1, np.int64)
        cuts[::PARTS] = begin
        cuts[1::PARTS], cuts[2::PARTS] = begin[:-1], begin[1:]
        cuts[PARTS * odd + 1] += feed[odd]
        cuts[PARTS * odd + 2] = begin[odd] + length[odd]
        return pa.LargeStringArray.from_buffers(PARTS * n, pa.py_buffer(cuts), pieces.buffers()[2])

    def _library(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in got]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        if self.between is None or any(self.between in p for p in pieces):
            return self._library(pieces)
        out: list[bytes] = []
        for lo in range(0, len(pieces), TOGETHER):
            part = pieces[lo:lo + TOGETHER]
            got = self.tokenizer.encode_batch_fast([self.between.join(part)], add_special_tokens=False)[0].ids
            ids = np.array(got, "<u4")
            ends = [*np.nonzero(ids == self.between_id)[0].tolist(), len(ids)]
            raw, start = ids.tobytes(), 0
            for end in ends:
                out.append(raw[4 * start:4 * end])
                start = end + 1
        return out

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces not met lately.  The library's model gives those of a
        word, letters or marks alone, without its search for words."""
        known, older, folds, in_bytes, space = self.known, self.older, self.folds, self.in_bytes, self.space
        tokenize = self.model.tokenize
        here, others = {}, []
        for p, ids in zip(pieces, map(older.get, pieces)):
            if ids is not None:
                here[p] = ids
                continue
            if p.isascii() and p.isalpha():
                lead, word = "", p
            elif m := _WORD(p):
                lead, word = m.groups()
            else:
                others.append(p)
                continue
            if folds and word != word.lower():
                others.append(p)
                continue
            if not word.isascii():
                word = word.translate(in_bytes)
            here[p] = array("I", [t.id for t in tokenize(space + word if lead else word)]).tobytes()
        split, cores = [], set()
        for p in others:
            core = p.rstrip(".,;:!?")
            if not core or not core[-1].isalnum() or _MAY_JOIN(p):
                core = p
            first = "\n" if core[:1] == "\n" and len(core) > 1 and core[1] not in " \n" else ""
            parts = (first, core[len(first):], p[len(core):])
            split.append((p, parts))
            cores.update(x for x in parts if x and x not in known and x not in here)
        for x in cores & older.keys():
            here[x] = older[x]
        left = [x for x in cores if x not in here]
        here.update(zip(left, self._pieces(left)))
        for p, parts in split:
            if p not in here:
                here[p] = b"".join([here[x] if x in here else known[x] for x in parts if x])
        return here

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KEPT_PIECES:
            self.known, self.older = {}, self.known
        known = self.known
        out: list[bytes | None] = [None] * len(texts)
        whole, split, parts, listed, lists = [], [], [], [], []
        for i, text in enumerate(texts):
            pieces = self._cut(text)
            if pieces is None:
                whole.append(i)
            elif isinstance(pieces, str):
                split.append(i)
                parts.append(pieces)
            else:
                listed.append(i)
                lists.append(pieces)
        found = self._split(pa.array(parts, pa.large_string()))
        ends = np.cumsum([0, *found.value_lengths().to_pylist(), *map(len, lists)])
        met = pa.concat_arrays([found.flatten(), pa.array(chain.from_iterable(lists), pa.large_string())]).dictionary_encode()
        # each part of a piece is looked up once in these texts, however often it comes
        parts = self._parts(met.dictionary).dictionary_encode()
        words = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        got = list(map(known.get, words))
        missing = [at for at, ids in enumerate(got) if ids is None]
        here = self._new([words[at] for at in missing])
        for at in missing:
            got[at] = here[words[at]]
        for p in [p for p in here if len(p) > KEPT_LENGTH or p[:1] == "\n" and p != "\n"]:
            del here[p]
        known.update(here)
        ids = pa.array(got, pa.large_binary()).take(parts.indices)
        offsets = np.frombuffer(ids.buffers()[1] or bytes(8), np.int64)[:len(ids) + 1:PARTS]
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(met.dictionary),
                                               [None, pa.py_buffer(np.ascontiguousarray(offsets)), ids.buffers()[2]])
        ids = ids.take(met.indices)
        places = np.frombuffer(ids.buffers()[1] or bytes(8), np.int64)[ends].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        for i, start, end in zip(split + listed, places, places[1:]):
            out[i] = raw[start:end].tobytes()
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        return out


_encoders: dict[str, PieceEncoder] = {}


def encoder(name: str) -> PieceEncoder:
    """The worker's encoder of a public vocabulary file; the next tasks of the
    same worker find the pieces it has met."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = PieceEncoder(tokenizer_file(name))
    return _encoders[name]


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file, looked up where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)
