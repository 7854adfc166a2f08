from __future__ import annotations

import hashlib
import math
from collections import Counter

from gleanery.llm import imatch

from messy_rows import MESSY


def test_lexicon_is_the_band_over_all_texts(spark, sf_dir, texts):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    counts = Counter(w.decode() for t in texts.values() for w in set(imatch.terms(t)))
    n = len(texts)
    want = {w for w, c in counts.items() if math.exp(-imatch.IDF_HIGH) * n <= c <= math.exp(-imatch.IDF_LOW) * n}
    assert set(imatch.lexicon_terms(frame)) == want


def test_fingerprints_hash_sorted_terms_of_random_subsets():
    lexicon = imatch.Lexicon([f"w{i}" for i in range(3000)])
    assert [abs(lexicon.member[:, i].mean() / imatch.RATES[i // imatch.SUBSETS] - 1) < 0.9 for i in range(36)]
    text = " ".join(f"w{i}" for i in range(0, 600, 2))
    print_ = lexicon.fingerprint(text)
    assert print_ == lexicon.fingerprint(" ".join(reversed(text.split())) + " w0 unknown")
    changed = lexicon.fingerprint(text.replace("w0 ", "w1 "))
    parts = [[p[16 + 8 * i : 24 + 8 * i] for i in range(60)] for p in (print_, changed)]
    for i, (a, b) in enumerate(zip(*parts)):
        same = lexicon.member[lexicon.number[b"w0"], i] == lexicon.member[lexicon.number[b"w1"], i] == False  # noqa: E712
        assert (a == b) == same or not same


def test_likeness_follows_the_share_of_common_terms():
    lexicon = imatch.Lexicon([f"w{i}" for i in range(5000)])
    base = [f"w{i}" for i in range(0, 2000, 4)]
    means = []
    for kept in (1.0, 0.9, 0.6, 0.2, 0.0):
        keep = int(kept * 500)
        found = [
            imatch.likeness([(
                lexicon.fingerprint(" ".join(base)),
                lexicon.fingerprint(" ".join(base[:keep] + [f"w{(i * 4 + 1 + s) % 5000}" for i in range(500 - keep)])),
            )])[0]
            for s in (0, 2)
        ]
        means.append(sum(found) / len(found))
    assert means[0] == 1.0 and means == sorted(means, reverse=True) and means[-1] < 0.15
    a, b = lexicon.fingerprint("none of these"), lexicon.fingerprint("nor those")
    assert imatch.likeness([(a, a), (a, b)]) == [1.0, 0.0] and imatch.likeness([]) == []


def plain_edits(rows):
    """By id: the edited text; ``rows`` are ``(id, text)``, in order of the next."""
    out = []
    for i, (id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        n = len(text)
        out.append((id, n, text[: n - n // 3] + after[: n // 3]))
    return out


def test_query_edits_with_the_next_document(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in imatch.op2_fingerprints(spark, sf_dir).collect()}
    ordered = sorted(texts.items(), reverse=True)
    near = []
    for id, n, edited in plain_edits(ordered):
        r = rows[id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        near.append((r.near_edited, r.near_next))
    assert len(rows) == len(texts)
    assert sum(a > b for a, b in near) > 0.9 * len(near)
    equal: dict = {}
    for id, text in texts.items():
        assert equal.setdefault(text, rows[id].fingerprint) == rows[id].fingerprint


def test_messy_rows(spark, messy, empty):
    words = imatch.lexicon_terms(messy)
    rows = imatch.with_next(messy, words).collect()
    ordered = sorted(((r[0], r[1] or "") for r in MESSY), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    got = sorted((r.id is None, r.id or 0, r.n_chars, r.edited) for r in rows)
    assert got == sorted((id is None, id or 0, n, e) for id, n, e in plain_edits(ordered))
    assert imatch.with_next(empty, imatch.lexicon_terms(empty)).collect() == []
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert [r.edited for r in imatch.with_next(one, []).collect()] == ["abcdab"]


def test_copies_that_hold_a_third_of_the_rows_have_terms(spark):
    hot = " ".join(f"hot{i}" for i in range(90))
    rows = [(i, hot if i % 3 == 0 else " ".join(f"w{(i * 37 + k * k) % 900}" for k in range(90))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    words = imatch.full_lexicon(frame)
    assert set(hot.split()) <= set(words) and len(words) == len(set(words))
    assert not set(hot.split()) & set(imatch.lexicon_terms(frame))
    found = {r.id: r for r in imatch.with_next(frame, words).collect()}
    assert len(found) == len(rows)
    for i in range(0, 120, 3):
        assert found[i].near_edited > 0.2 and found[i].near_next < found[i].near_edited
