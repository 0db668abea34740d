"""Packing of texts on which the fast encoder fails."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.entry import TOKENIZER


@pytest.mark.parametrize("text", [" " * 1_200_000 + "x", "a" + "\n" * 1_200_000, " \t\r\n" * 300_000, "x" + "\u00a0" * 1_200_000 + "y", " " * 150_000 + "word"])
def test_long_blanks_encode_as_by_tokenizers(text):
    assert packing.encoder(TOKENIZER)(text) == Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids


def test_long_punctuation_encodes_as_by_tokenizers():
    text = "-=" * 600_000
    assert packing.encoder(TOKENIZER)(text) == Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids


def test_a_panic_of_the_fast_encoder_is_caught(monkeypatch):
    monkeypatch.setattr(packing, "BLANKS", 10**9)
    encode = packing.encoder(TOKENIZER)
    own = Tokenizer.from_file(TOKENIZER)
    for text in (" " * 1_200_000 + "x", "it goes on"):
        assert encode(text) == own.encode(text, add_special_tokens=False).ids


def test_other_rows_stay_packed(spark):
    texts = {1: "hello world", 2: " " * 1_200_000 + "x"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.pack(docs, TOKENIZER, limit=2048).collect()
    own = Tokenizer.from_file(TOKENIZER)
    for key, text in texts.items():
        ids = [*own.encode(text, add_special_tokens=False).ids, 0]
        cut = sorted((r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == key)
        assert {n for s, length, _ in cut for n in range(s, s + length)} == set(range(len(ids)))
        for start, length, crc in cut:
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())


def test_files_with_other_rules_are_run_by_tokenizers(tmp_path):
    import json

    with open(TOKENIZER, encoding="utf-8") as f:
        text = f.read()
    assert packing.runs_by_rank(json.loads(text))
    for n, change in enumerate((
        lambda d: d["model"]["merges"].insert(0, d["model"]["merges"].pop(5000)), lambda d: d["pre_tokenizer"].update(add_prefix_space=True),
        lambda d: d.update(normalizer={"type": "Lowercase"}),
    )):
        file = json.loads(text)
        change(file)
        assert not packing.runs_by_rank(file)
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps(file), encoding="utf-8")
        sample = "Hello there, THE quick brown Fox; it's 12 o'clock"
        assert packing.encoder(str(path))(sample) == Tokenizer.from_file(str(path)).encode(sample, add_special_tokens=False).ids


def test_random_texts_encode_as_by_tokenizers():
    import random

    rng = random.Random(12)
    own = Tokenizer.from_file(TOKENIZER)
    encode = packing.encoder(TOKENIZER)
    letters = ["a", "the", " ", "  ", "\n", "\t", "'s", "'", "é", "中文", "🙂", "\u00a0", "\u2028", "0", "123", "_", "--", "ſ", "ñandú", "\x00", "\u0301", "Ⅷ", "²", "WE'LL", "\r\n"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        assert encode(text) == own.encode(text, add_special_tokens=False).ids, repr(text)
