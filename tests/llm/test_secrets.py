from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest

from gleanery.llm import secrets

from messy_rows import MESSY


def plain_base(text):
    """The three patterns as they are described, matches that are too short dropped."""
    words = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                     for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_base_spans_on_random_texts(texts):
    draw = random.Random(2)
    parts = ["password", "PassWd", "token", "ſecret", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abcdef",
             "AKIA", "ABCDEFGH12", "0123456789abcdef", "é", "-", "x", "\n"]
    random_texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(4000)]
    for text in [*random_texts, *texts.values()]:
        assert [x[:3] for x in secrets.base_spans(text)] == plain_base(text), text


def trained(spark, texts):
    return secrets.train(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))


#: What scans for secrets must leave alone.
ORDINARY = [
    "2024-01-15T10-30-00-000Z", "550e8400-e29b-41d4-a716-446655440000", "f47ac10b-58cc-4372-a567-0e02b2c3d479",
    "MAXIMUM_RETRY_COUNT_EXCEEDED", "getElementByIdAndClassName", "12345678901234567890", "98374650192837465019",
    "/var/log/app/2024/01/15/server", "data/2023-11-05/export_final", "A" * 24, "-" * 30, "internationalization",
    "XMLHttpRequestFactoryBean", "src/main/java/com/example/util", "application/x-www-form-urlencoded",
    "v1-2-3-beta-20240101", "get_user_account_settings", "utf8_general_ci_collation", "iso-8859-1-encoding",
]


@pytest.fixture(scope="module")
def model(spark):
    return secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_models_tell_random_strings_from_identifiers(spark, model):
    """Held-out: strings and words that no training text has."""
    scanner, draw = secrets.Scanner(model), random.Random(4)
    letters = string.ascii_letters + string.digits
    for alphabet in (letters, letters + "+/", letters + "_-", string.ascii_uppercase + string.digits):
        for size in (16, 20, 32, 64):
            drawn = ["".join(draw.choice(alphabet) for _ in range(size)) for _ in range(200)]
            assert sum(scanner.random(x) for x in drawn) >= 0.95 * len(drawn)
    assert [x for x in ORDINARY if scanner.random(x)] == []
    held = {w for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id > 9000").collect()
            for w in re.findall(r"[A-Za-z0-9_/-]{12,}", r.text) if not secrets.base_spans(f"={w}")}
    words = sorted(held)[:1000]
    assert sum(scanner.random(w) for w in words) <= 0.01 * len(words)


def test_ordinary_strings_stay_in_a_redacted_text(spark, model):
    key = "kR3vTz9QpL0sWx7YbN2m"
    rows = [(i, f"see {x} or ({x})") for i, x in enumerate(ORDINARY)] + [(99, f"see {key} here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in secrets.redacted(frame, model).collect()} == dict(rows) | {99: "see [secret] here"}


def test_model_spans_against_a_plain_scan(texts, model):
    """Every span by walking over characters and adding logarithms one by one."""
    letters = random.Random(6)
    odd = ["".join(letters.choice(string.ascii_letters + "0123456789+/ =_-") for _ in range(300)) for _ in range(40)]
    scanner = secrets.Scanner(model)
    for text in [*texts.values(), *odd, *(f"password={o}{o}" for o in ("Zk3vQ9xLm2Np8RtY", "A" * 20))]:
        base = plain_base(text)
        covered = {i for a, _, b in base for i in range(a, b)}
        found, at = [], 0
        while at < len(text):
            stop = at
            while stop < len(text) and text[stop] in secrets.ALPHABET:
                stop += 1
            if stop - at >= 16:
                start = at
                while start < stop:
                    if start in covered:
                        start += 1
                        continue
                    end = start
                    while end < stop and end not in covered:
                        end += 1
                    total, before = 0.0, secrets._START
                    for c in text[start:end]:
                        now = secrets.ALPHABET.index(c)
                        total += model.ratios[before * secrets.SIZE + now]
                        before = now
                    if total > max(15.0, 0.5 * (end - start)):
                        found.append((start, 3, end))
                    start = end
            at = max(stop, at + 1)
        assert [s for s in scanner.spans(text) if s[1] == 3] == found


def test_counts_are_those_of_all_texts(spark, texts):
    """The trained ratios against counting letter by letter."""
    texts = texts | {-1: "password=Zk3vQ9xLm2Np and AKIA" + "B2" * 10, -2: "token: a.b.c_d=e9"}
    counts = [Counter(), Counter()]
    documents = Counter()
    for text in texts.values():
        base = plain_base(text)
        tokens = [m for m in re.finditer(r"[A-Za-z0-9+/_=-]{4,}", text)]
        documents.update({m[0] for m in tokens if not any(a < m.end() and m.start() < b for a, _, b in base)})
    samples = [[(t, n) for t, n in documents.items() if n >= 2], [(s, 1) for t in texts.values() for *_, s in secrets.base_spans(t)]]
    drawn = [Counter(), Counter()]
    for own, (given, more) in enumerate(zip(samples, secrets.drawn_samples())):
        for into, strings in ((counts[own], given), (drawn[own], [(s, 1) for s in more])):
            for s, n in strings:
                before = secrets._START
                for c in s:
                    now = secrets.ALPHABET.find(c)
                    now = secrets._START if now < 0 else now
                    if now != secrets._START:
                        into[before, now] += n
                    before = now
    size, known = secrets.SIZE, trained(spark, texts)
    # half of a model's transitions are drawn ones', all where the corpus has none
    scale = [sum(c.values()) / sum(d.values()) or 1.0 for c, d in zip(counts, drawn)]
    whole = [{m: c[m] + d[m] * x for m in {*c, *d}} for c, d, x in zip(counts, drawn, scale)]
    for a, b in random.Random(1).sample([(a, b) for a in range(size) for b in range(size)], 200):
        logs = [math.log((c.get((a, b), 0) + 0.5) / (sum(c.get((a, x), 0) for x in range(size)) + 0.5 * size)) for c in whole]
        assert math.isclose(known.ratios[a * size + b], logs[1] - logs[0], abs_tol=1e-9)


def test_query_digests(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in secrets.op9_secrets(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        base = plain_base(text)
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (rows[i].n_assign, rows[i].n_access, rows[i].n_hex) == tuple(
            sum(k == n for _, k, _ in base) for n in range(3)
        )
        assert set(joined.split(",")) <= {*rows[i].spans.split(","), ""}


def test_messy_rows(spark, messy, empty):
    model = secrets.train(messy)
    rows = secrets.scan(messy, model).collect()
    assert len(rows) == len(MESSY)
    assert [r.spans for r in rows if not (r.text or "").strip()] == [[]] * 4
    clean = secrets.redacted(messy, model)
    assert clean.columns == messy.columns
    found = {r.text for r in clean.collect()}
    assert None in found and "You are an idiot, a worthless idiot. [secret]" in found
    assert secrets.scan(empty, secrets.train(empty)).collect() == []


def test_overlapping_spans_become_one_mark():
    assert secrets.blank("ab cdef gh", [(3, 0, 6), (4, 2, 7)], "*") == "ab * gh"


def test_what_lies_beside_a_pattern_is_judged():
    key, rest, run = "AKIA" + "QX7" * 6, "kR3vTz9" * 6, "0123456789abcdef" * 2
    text = f"see {key}/{rest} and Zq{run}ZZwQ9xTT or {run}"
    at, hexed = text.index("/"), text.index("Zq")
    for nats, short in ((1.0, False), (2.0, True)):
        scanner = secrets.Scanner(secrets.Model((nats,) * secrets.SIZE**2))
        found = [s for s in scanner.spans(text) if s[1] == 3]
        want = [(at, 3, at + 1 + len(rest))]
        assert found == want + [(hexed + 2 + len(run), 3, hexed + 10 + len(run))] * short
    assert rest not in secrets.blank(text, scanner.spans(text), "*")
    assert scanner.spans("Zq" + run) == [(2, 2, 34)]  # two characters are too few
    plain = secrets.Scanner(secrets.Model((0.1,) * secrets.SIZE**2))
    assert {k for _, k, _ in plain.spans(text)} == {1, 2}
