"""Ids of pieces: as the library gives them, words without its search."""

import random

import pytest

from lodestar.llm.tokens import PieceEncoder, tokenizer_file

CHARS = list(" \n\nabcXYZéßÉŉʰªº²¼×÷'’.,!?%$*_-<|>0129\tİÀǅ́中\x1c\0") + ["'s", "'re", "<|endoftext|>", " the", "\r\n"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(name):
    rng, coder = random.Random(7), PieceEncoder(tokenizer_file(name))
    texts = ["".join(rng.choices(CHARS, k=rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rng.choices(" \n éßabA***.,%", k=rng.randint(0, 30))) for _ in range(4000)]
    want = coder._library(texts)
    for _ in range(2):  # again with the pieces met
        assert [ids for lo in range(0, len(texts), 256) for ids in coder.encode(texts[lo:lo + 256])] == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_need_no_search(name, monkeypatch):
    coder, searched = PieceEncoder(tokenizer_file(name)), []
    whole = coder._pieces
    monkeypatch.setattr(coder, "_pieces", lambda pieces: searched.extend(pieces) or whole(pieces))
    texts = ["Zwölf größere façades *** día%%% naïve, l'été 42\nÉtait-ce"]
    assert coder.encode(texts) == coder._library(texts)
    assert {p.strip().lower() for p in searched if any(c.isalpha() for c in p)} == {"l'été", "était-ce"}


class _Counted(dict):
    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_piece_is_looked_up_once_in_its_texts(name):
    coder = PieceEncoder(tokenizer_file(name))
    coder.known, coder.older = _Counted(), _Counted()
    texts = ["Zwei alte Katzen, zwei Hunde.\nZwei alte Hunde..." * 500] * 4 + ["", "\n", "\x1c", "zwei  alte\n\nKatzen"]
    assert coder.encode(texts) == coder._library(texts)
    assert coder.known.asked < 100 and coder.older.asked < 100
    assert coder.encode([]) == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_marks_are_cut_from_letters_only(name):
    coder = PieceEncoder(tokenizer_file(name))
    texts = ["a<|endoftext|> <|endoftext|> <|endoftext|>.. x<|startoftext|>!", "1999. 12,5%%% a1. it's. l'.", "\nÀB.\n12.\n...\n\0.",
             "ÉTÉ... é́. İ. ǅ! ˆ? ʰ¿.", "AB. 中. <| ab.", "... ' '. .' ,a. ,a,a"]
    for text in texts:
        assert coder.encode([text]) == coder._library([text])
    for _ in range(2):  # together, and with the pieces met
        assert coder.encode(texts) == coder._library(texts)
