from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gleanery.llm import common, secrets, toxicity
from test_shingles import plain_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The tables before and after every stage, as lists of rows."""
    docs, out = common.table(spark, sf_dir, "documents"), []
    out.append(docs.collect())
    for name, function in corpus_pipeline.STAGES:
        docs = common.stage(function(spark, docs, sf_dir), name)
        out.append(docs.collect())
    return out


def test_rows_above_the_threshold_go(spark, sf_dir, stages):
    documents = common.table(spark, sf_dir, "documents")
    model = toxicity.learn(documents, common.table(spark, sf_dir, "labels"), ~toxicity.held_out())
    matcher = toxicity.Matcher(model)
    before, after = stages[0], stages[1]
    assert Counter(after) == Counter(r for r in before if matcher.score(r.text) < toxicity.THRESHOLD)
    assert 0 < len(after) < len(before)


def test_one_of_each_group_stays(stages):
    before, after = sorted(stages[1], key=lambda r: r.doc_id), stages[2]
    top = plain_groups([r.text for r in before])
    assert Counter(after) == Counter(r for place, r in enumerate(before) if top[place] == place)


def test_secrets_are_replaced(stages):
    before, after = {r.doc_id: r for r in stages[2]}, {r.doc_id: r for r in stages[3]}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        if not secrets.base_spans(before[i].text):
            assert r.text == before[i].text
    assert not any(secrets.base_spans(r.text) for r in after.values())


def test_every_document_is_drawn_once_or_twice(stages):
    counts = Counter(r.doc_id for r in stages[4])
    assert counts.keys() == {r.doc_id for r in stages[3]}
    assert set(counts.values()) <= {1, 2}
    assert set(stages[4]) == set(stages[3])


def test_ids_are_those_of_the_library(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert Counter((r.doc_id, r.text) for r in stages[5]) == Counter((r.doc_id, r.text) for r in stages[4])
    for r in stages[5]:
        assert r.round_trip and r.ids == library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids)


def test_columns_between_stages(spark, sf_dir, stages):
    for rows in stages[:-1]:
        assert rows[0].__fields__ == COLUMNS


def test_messy_and_empty_tables_pass_all_stages(spark, sf_dir, messy, empty):
    for given, least in ((messy, 1), (empty, 0)):
        docs = given
        for name, function in corpus_pipeline.STAGES:
            docs = common.stage(function(spark, docs, sf_dir), name)
        rows = docs.collect()
        assert len(rows) >= least and all(r.round_trip for r in rows)
        assert docs.columns[: len(given.columns)] == given.columns
