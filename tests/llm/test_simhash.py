from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from gleanery.llm import components, simhash
from messy_rows import MESSY


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            words += [word] * bool(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """Index of the first member of each one's component, by comparing all pairs."""
    top = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and top[i] != top[j]:
                old, new = max(top[i], top[j]), min(top[i], top[j])
                top = [new if t == old else t for t in top]
    return top


def test_fingerprints_are_those_of_the_definition(texts):
    for text in [*list(texts.values())[:60], "", "one", "One TWO", "a b c", "a b c d", "É é x y\x1fz"]:
        assert simhash.fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)


def test_any_five_positions_hold_a_list():
    from itertools import combinations

    assert len(simhash.POSITIONS) == 14
    for five in combinations(range(8), 5):
        assert any(set(four) <= set(five) for four in simhash.POSITIONS)


def clustered(seed, size):
    """Fingerprints in chains and clouds around few centres."""
    draw, out = random.Random(seed), {0, 2**64 - 1}
    while len(out) < size:
        base = draw.getrandbits(64)
        for _ in range(draw.randint(1, 12)):
            for _ in range(draw.randint(0, 4)):
                base ^= 1 << draw.randrange(64)
            out.add(base)
    return sorted(out)


@pytest.mark.parametrize("limit", [4096, 2])
def test_links_connect_what_all_pairs_connect(spark, limit):
    """Both for lists compared in a task and for those linked by centres."""
    fps = clustered(limit, 150)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(7, x) for x in signed] + [(2, x) for x in signed[:40]], "table int, fp long")
    found = simhash.links(frame, limit)
    assert {r.table for r in found.select("table").distinct().collect()} == {2, 7}
    found = found.where("table = 7").collect()
    place = {x: i for i, x in enumerate(signed)}
    for r in found:
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 3
    top = list(range(len(fps)))
    for r in found:
        a, b = sorted((top[place[r.a]], top[place[r.b]]))
        top = [a if t == b else t for t in top]
    assert top == plain_components(fps)


def test_components_of_chains_stars_and_repeats(spark):
    draw = random.Random(5)
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 30)]
    loose = [(2000 + draw.randrange(60), 2000 + draw.randrange(60)) for _ in range(40)]
    pairs = [*chain, *star, *loose, (5, 5), (None, 3), (-7, 40)]
    found = components.roots(spark.createDataFrame(pairs + pairs[:9], "a long, b long"))
    got = {r.a: r.b for r in found.collect()}
    top: dict[int, int] = {}
    for a, b in pairs:
        if a is not None:
            top.setdefault(a, a), top.setdefault(b, b)
            low, high = sorted((top[a], top[b]))
            top = {k: low if v == high else v for k, v in top.items()}
    assert got == {k: v for k, v in top.items() if k != v}
    assert components.roots(spark.createDataFrame([], "a long, b long")).collect() == []


def test_several_tables_against_all_pairs(spark, sf_dir, texts):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = sorted(texts)
    prints = [simhash.table_fingerprints(texts[i], 2, 4) for i in ids]
    assert [p[0] for p in prints] == [simhash.fingerprint(texts[i], 2) for i in ids]
    top = list(range(len(ids)))
    for t in range(4):
        alone = plain_components([p[t] & (2**64 - 1) for p in prints])
        for i, j in enumerate(alone):
            a, b = sorted((top[i], top[j]))
            top = [a if x == b else x for x in top]
    found = simhash.near_duplicates(frame, words=2, tables=4).collect()
    assert {r.id: r.component for r in found} == {i: ids[t] for i, t in zip(ids, top)}


def test_tables_find_what_shares_most_shingles(texts):
    """Against the share of common five-word shingles of all pairs."""
    found = {i: simhash.table_fingerprints(t, 2, 8) for i, t in texts.items()}
    shingles = {i: set(zip(*(t.lower().split()[k:] for k in range(5)))) for i, t in texts.items()}
    for i, a in found.items():
        for j, b in found.items():
            both = shingles[i] | shingles[j]
            if i < j and len(both) > 20 and any((x ^ y).bit_count() <= 3 for x, y in zip(a, b)):
                assert len(shingles[i] & shingles[j]) >= 0.5 * len(both)


def test_query_against_all_pairs(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in simhash.op4_simhash(spark, sf_dir).collect()}
    ids = list(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    top = plain_components(fps)
    assert {i: (f"{f:016x}", ids[t]) for i, f, t in zip(ids, fps, top)} == {
        i: (r.fingerprint, r.component_id) for i, r in rows.items()
    }


def test_messy_rows(spark, messy, empty):
    rows = simhash.near_duplicates(messy).collect()
    assert len(rows) == len(MESSY)
    blank = {r.component for r in rows if r.fp == 0}
    assert blank == {2}  # null, empty and blank texts are linked; null ids are never smallest
    assert {r.component for r in rows if r.id in (5, 6)} == {5}
    assert [r.component for r in rows if r.id is None and r.fp] == [None]
    assert simhash.near_duplicates(empty).collect() == []
    kept = simhash.one_of_each(messy)
    assert kept.columns == messy.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 4, 5, 8, None]
    assert simhash.one_of_each(empty).collect() == []
