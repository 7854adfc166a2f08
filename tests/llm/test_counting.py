from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gleanery.llm import counting, packing

from messy_rows import MESSY


@pytest.fixture(scope="module")
def ranks():
    return packing.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def replaced(text, start, removed, inserted):
    start = min(max(start, 0), len(text))
    return text[:start] + inserted + text[min(start + max(removed, 0), len(text)) :]


def test_random_edits_keep_the_leaves_of_a_whole_split(ranks):
    count, draw = counting.counter(ranks), random.Random(9)
    parts = ["a", "b", "'", "r", "e", "s", " ", "  ", "\n", "1", ".", "the", " in", "é", "人", "ll", "t", "\t", "!?"]

    def drawn(n):
        return "".join(draw.choice(parts) for _ in range(draw.randint(0, n)))

    for _ in range(4000):
        text = drawn(60)
        words = counting._SPLIT.findall(text)
        own = counting.Counted(text, list(map(len, words)), count(words), count)
        for _ in range(draw.randint(1, 5)):
            edit = draw.randint(-2, len(text) + 3), draw.randint(0, 8), drawn(6)
            text = replaced(text, *edit)
            own.edit(*edit)
            words = counting._SPLIT.findall(text)
            leaves = [own.tree.leaf(i) for i in range(own.tree.leaves)]
            assert own.text == text
            assert [n for x, _ in leaves for n in x] == list(map(len, words)), (text, edit)
            assert [x.tolist() for x in own.tree.arrays()] == [list(map(len, words)), count(words)]
            assert [n for _, x in leaves for n in x] == count(words)
            assert own.tree.length[1] == len(text) and own.tokens == sum(count(words))


def test_little_is_encoded_anew(ranks, texts):
    count = counting.counter(ranks)
    text = max(texts.values(), key=len)
    words = counting._SPLIT.findall(text)
    own = counting.Counted(text, list(map(len, words)), count(words), count)
    assert len(words) > 1000
    assert own.edit(len(text) // 2, 5, "some new words") < 20


def test_query_against_encoding_whole_texts(spark, sf_dir, texts, ranks):
    encode = packing.encoder(ranks).encode_ordinary
    rows = {r.doc_id: r for r in counting.op10_edit_counts(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    for id, text in texts.items():
        n, edited = len(text), text
        for edit in ((n // 4, 0, text[2:19]), (n // 2, 12, text[:9]), (n * 3 // 4, 23, "")):
            edited = replaced(edited, *edit)
        assert rows[id].n_tokens == len(encode(text))
        assert rows[id].edited_tokens == len(encode(edited))
        assert rows[id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_messy_rows(spark, messy, empty, ranks):
    indexed = counting.index(messy.withColumnsRenamed({"score": "Counts", "lang": "LENGTHS"}), ranks)
    edit = F.struct(F.lit(3).cast("long").alias("start"), F.lit(None).cast("long").alias("removed"), F.lit("x y").alias("inserted"))
    edits = F.when(F.col("doc_id") != 5, F.array(edit, F.lit(None)))
    rows = counting.recount(indexed, ranks, edits).collect()
    encode = packing.encoder(ranks).encode_ordinary
    assert len(rows) == len(MESSY)
    given = {r[0]: r[1] or "" for r in MESSY if r[0] is not None}
    for r in rows:
        if r.doc_id is not None:
            text = given[r.doc_id]
            assert r.text == (text if r.doc_id == 5 else replaced(text, 3, 0, "x y"))
        assert r.edited_tokens == len(encode(r.text)) == sum(r.counts) and sum(r.lengths) == len(r.text)
    assert counting.recount(counting.index(empty, ranks), ranks, F.lit(None)).collect() == []
