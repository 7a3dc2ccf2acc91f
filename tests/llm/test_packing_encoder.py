"""The packing's encoder: the library's ids, each distinct stretch looked up once a block."""

import random

import numpy as np
import pyarrow as pa
import pytest

from wingspan.llm import packing
from wingspan.llm.packing import Encoder, blocks, stretches

PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\t", " ", "'", "'s", "'S", "a", "Z", "ß", "ẞ", "é", "É", "é", "́", "İ", "ı", "ÿ.", "÷.", "×", "º", "ǅ",
         "Σ", "ς", "я.", "Я", "漢", "한", "１", "²", "0.", ".", ",", "...", "!?", "#$%&*", "|", "-", "<|", "|>", "<|startoftext|>", "<|ENDOFTEXT|>",
         "<|endoftext|>.", "\x00", "😀", "ﬁ", "̸", "K", "the", "The.", "word,", "www.a.b", "x.y ", "tion", "ö.ü", " .a", "ɏ", "ɐ", "Ⱥ", "ª"]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


class Counting(dict):
    asked = 0

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


def test_a_stretch_is_looked_up_once_a_block(encoder):
    encoder.known = Counting()
    column = pa.array(["the cat. " * 5000, "the cat sat " * 5000])
    ids = encoder.texts(column)
    assert [len(x) // 4 for x in ids] == [15000, 15000]
    assert encoder.known.asked == 4  # the, cat, ., sat; not 25000 words
    encoder.known = {}


def test_plain_words_skip_the_normalizer(encoder, monkeypatch):
    column = pa.array(["Über den Wolken là où ça naît"])
    want = encoder.tokenizer.encode(column[0].as_py(), add_special_tokens=False).ids

    class Refuses:
        def encode_batch_fast(self, *_, **__):
            raise AssertionError("plain words went through the whole library")

    encoder.known = {}
    monkeypatch.setattr(encoder, "tokenizer", Refuses())
    assert np.frombuffer(encoder.texts(column)[0], "<u4").tolist() == want


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_ids_are_the_librarys(encoder, kind):
    rng = random.Random(3)
    texts = [None, "", " ", "\n\n", "."] + ["".join(rng.choices(PARTS, k=rng.randint(0, rng.choice([3, 8, 40])))) for _ in range(3000)]
    column = pa.array([*texts, "", None], kind)
    for part in (column, column.slice(3, 500), pa.array([None, ""], kind), pa.array([], kind)):
        got = encoder.texts(part)
        assert got == [np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in part.to_pylist()]


def test_memory_beyond_its_bound(encoder, monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 3)
    for text in ("one two three four five", "five six", "one six seven"):
        assert np.frombuffer(encoder.texts(pa.array([text]))[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_blocks_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 10)
    texts = ["abc", None, "x" * 35, "", "", None, "ab", "é" * 9, "z"]
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(blocks(b))
    assert len(parts) > 2 and all(p.num_rows for p in parts)
    assert [r for p in parts for r in p.to_pylist()] == b.to_pylist()
    assert list(blocks(b.slice(0, 0))) == []


def test_stretches_are_cut_where_a_letter_meets_a_mark():
    words, first = stretches(pa.array(["A cat.  b÷. ñ! 5.", None, "x<|.a. B", ""]))
    assert words.to_pylist() == ["a", "cat", ".", "b÷.", "ñ", "!", "5.", "x<|.a.", "B"]
    assert first.tolist() == [0, 7, 7, 9, 9]
