from __future__ import annotations

import hashlib
import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gleanery.llm import bpe
from messy_rows import MESSY

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(FILE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def ids_of(tool, text):
    return array("i", tool.encode(text)).tolist()


def test_random_texts_encode_as_the_library_does(vocabulary, library):
    tool, draw = bpe.Codec(vocabulary), random.Random(7)
    parts = ["in", "er", "th", "he", "a", "aa", " ", "  ", "re", "s", "\n", "'s", "é", "人", "0", "<|endoftext|>", "!!"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 3000, "=-" * 700, "　x\u0085y", "a\x00b", "ſK", " ​ "]
    for text, known in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(tool, text) == known.ids, text
        assert tool.decode(known.ids) == library.decode(known.ids, skip_special_tokens=False)


def test_every_character_is_split_as_the_library_does(vocabulary, library):
    tool = bpe.Codec(vocabulary)
    points = [c for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF]
    for start in range(0, len(points), 4000):
        texts = [f"x{chr(c)}1{chr(c)}. {chr(c)}" for c in points[start : start + 4000]]
        for text, known in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert ids_of(tool, text) == known.ids, ascii(text)


def test_gadgets_give_the_token_sequences_of_the_merges():
    """Against merging by rule order, for merges of a letter with itself among others."""
    draw = random.Random(3)
    for _ in range(60):
        labels, merges = [b"a", b"b", b"c"], []
        while len(labels) < 12:
            u, v = draw.randrange(len(labels)), draw.randrange(len(labels))
            if labels[u] + labels[v] not in labels:
                merges.append((u, v, len(labels)))
                labels.append(labels[u] + labels[v])
        tool = bpe.MergeAutomaton(labels, merges)
        for _ in range(60):
            word = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 14)))
            tokens = [labels.index(bytes([b])) for b in word]
            for u, v, w in merges:
                out, i = [], 0
                while i < len(tokens):
                    if tokens[i : i + 2] == [u, v]:
                        out.append(w)
                        i += 2
                    else:
                        out.append(tokens[i])
                        i += 1
                tokens = out
            assert tool.encode(word) == tokens, (word, merges)


def test_long_words_and_full_caches(vocabulary, library, monkeypatch):
    for name, value in (("REMEMBERED", 3), ("REMEMBERED_ARCS", 5)):
        monkeypatch.setattr(bpe, name, value)
    tool = bpe.Codec(vocabulary)
    for text in ["thequickbrownfox" * 40, "one two three four five six seven eight one two", "ab" * 20_000]:
        assert ids_of(tool, text) == library.encode(text, add_special_tokens=False).ids


def test_messy_rows(spark, messy, empty, vocabulary, library):
    coded = bpe.encode(messy.withColumnRenamed("score", "ids"), vocabulary)
    assert coded.columns == ["doc_id", "text", "lang", "source", "n_chars", "fingerprint", "ids"]
    rows = bpe.decode(coded, vocabulary, text="lang").collect()
    assert len(rows) == len(MESSY)
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.lang == (r.text or "")
    assert bpe.decode(bpe.encode(empty, vocabulary), vocabulary).collect() == []
    both = bpe.encode_and_decode(messy.withColumnsRenamed({"score": "Coded", "lang": "IDS"}), vocabulary)
    assert both.columns == ["doc_id", "text", "source", "n_chars", "fingerprint", "Coded", "ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in both.collect())


def test_query_digests(spark, sf_dir, texts, library):
    rows = {r.doc_id: r for r in bpe.op7_bpe(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Codec(bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))


def test_long_texts_are_coded_in_pieces(vocabulary, library, monkeypatch):
    tool = bpe.Codec(vocabulary)
    monkeypatch.setattr(bpe, "PIECE", 7)
    for text in ["two  words\n\n and 12 more, it's all 'round  " * 40, "déjà  vu — 漢字 👩‍👩‍👧  \t" * 40, " " * 50]:
        ids = ids_of(tool, text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert tool.decode(ids) == text
