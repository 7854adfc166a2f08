"""Secret scans: fixed patterns, and strings that look random to two Markov models.

The patterns find assignments, access keys and hexadecimal runs. The method adds strings of
``LEAST_CHARS`` or more token characters that a character model of random strings explains
better than one of ordinary identifiers: the log-likelihood ratio must exceed ``LEAST_NATS`` and
``LEAST_RATIO`` for each character, so short strings need more a character. Of a string that
overlaps the patterns' spans each piece outside them is judged by the same rule, whatever its length.

Both models are first-order, with a start state, and trained from labelled samples. Random are the
strings that the patterns found and strings drawn from the usual alphabets of keys. Ordinary are
whole tokens, digits, capitals, hyphens and slashes included, that the patterns don't cover and
that occur in several documents, and identifiers in the usual forms: names in each convention,
paths, numbers, dates, times, UUIDs and rulers. Every document contributes.
"""

from __future__ import annotations

import random
import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common

KINDS = ("assign", "access", "hex", "markov")
#: Shortest string that the models judge, the nats it must exceed, and those per character.
LEAST_CHARS, LEAST_NATS, LEAST_RATIO = 16, 15.0, 0.5
#: Documents that must have a token for it to be ordinary; its shortest length.
SEVERAL, TOKEN_CHARS = 2, 4
#: Drawn samples of each label, and the share of a model's transitions that are drawn ones'.
DRAWN, DRAWN_SHARE = 6000, 0.5
#: Tokens that a task counts before it hands them on.
COUNTED = 50_000
#: Added to each transition's count.
SMOOTHING = 0.5

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: What ASSIGN begins with, in lower case: without one of these there is no match.
_OPENERS = ("passw", "secret", "token", "api")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}")
_TOKENS = re.compile(rf"[A-Za-z0-9+/_=-]{{{TOKEN_CHARS},}}")
#: Ordinary words of identifiers, joined by rule.
NAMES = (
    "get set add put find load save read write open close start stop run make build parse format check test "
    "element class name value key index list map array table column row cell field record item node tree graph "
    "path file folder line word text string number count total sum mean maximum minimum limit size length width "
    "height user account group role session request response header body message event error warning exception "
    "retry exceeded reached timeout interval default option setting config environment variable parameter "
    "argument result output input buffer queue stack cache memory process thread worker server client host port "
    "address network protocol version release update create delete insert select join order filter sort search "
    "match replace image color style theme button window page link view model controller service module package "
    "library function method object instance property attribute by id and or to from with is has"
).split()
#: Letters that the models know; any other character has the last number.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_START = len(ALPHABET)
SIZE = len(ALPHABET) + 1
_NUMBER = np.full(256, _START, np.int64)
for _i, _c in enumerate(ALPHABET):
    _NUMBER[ord(_c)] = _i


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind number, end, secret)`` of the patterns' matches, in order."""
    found = []
    low = text.lower()
    if any(o in low for o in _OPENERS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    # a run of 24 or more is a whole run: nothing before it belongs to it
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def _outside(start: int, stop: int, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int]]:
    """The pieces from ``start`` to ``stop`` that no span of ``base`` covers, in order."""
    pieces = []
    for a, _, b, _ in base:
        if a < stop and start < b:
            if start < a:
                pieces.append((start, a))
            start = max(start, b)
    return [*pieces, (start, stop)] if start < stop else pieces


def transitions(*strings: str) -> np.ndarray:
    """Numbers of the strings' transitions, each string's first from the start state."""
    letters = "\0".join(strings).encode("latin-1", "replace")
    numbers = _NUMBER[np.frombuffer(letters, np.uint8)]
    before = np.concatenate(([_START], numbers[:-1]))
    return (before * SIZE + numbers)[numbers != _START]


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio, random to ordinary, of every transition, and what a string must exceed."""

    ratios: tuple[float, ...]
    least: float = LEAST_RATIO
    nats: float = LEAST_NATS


class Scanner:
    def __init__(self, model: Model):
        self.ratios, self.least, self.nats = np.array(model.ratios), model.least, model.nats

    def total(self, string: str) -> float:
        """Nats by which the random model explains the string better."""
        return float(self.ratios[transitions(string)].sum())

    def random(self, string: str) -> bool:
        """Whether the models call it random."""
        return self.total(string) > max(self.nats, self.least * len(string))

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """``(start, kind number, end)`` of all spans, in order of start, then kind."""
        base = base_spans(text)
        found = [(start, kind, stop) for start, kind, stop, _ in base]
        for m in _CANDIDATE.finditer(text):
            start, stop = m.span()
            # what lies between the patterns' matches, the whole if there are none
            for a, b in _outside(start, stop, base):
                if self.random(text[a:b]):
                    found.append((a, 3, b))
        return sorted(found)


def _samples(text: str) -> tuple[set[str], list[str]]:
    """Whole tokens that the patterns don't cover, and random strings of a text."""
    base = base_spans(text)
    if not base:
        return set(_TOKENS.findall(text)), []
    tokens = {m[0] for m in _TOKENS.finditer(text) if not any(a < m.end() and m.start() < b for a, _, b, _ in base)}
    return tokens, [s for *_, s in base]


def drawn_samples(seed: int = 1) -> tuple[list[str], list[str]]:
    """Ordinary identifiers in their usual forms, and random strings of keys' usual alphabets."""
    draw = random.Random(seed)
    letters = string.ascii_letters + string.digits
    alphabets = (letters, letters + "+/", letters + "_-", string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits)

    def names(least=1, most=4):
        return [draw.choice(NAMES) for _ in range(draw.randint(least, most))]

    def date(mark):
        return mark.join((f"{draw.randint(1970, 2039)}", f"{draw.randint(1, 12):02}", f"{draw.randint(1, 28):02}"))

    def time(mark):
        return mark.join(f"{draw.randint(0, 59):02}" for _ in range(3))

    def uuid():
        return "-".join("".join(draw.choice("0123456789abcdef") for _ in range(n)) for n in (8, 4, 4, 4, 12))

    def camel(words):
        return words[0] + "".join(w.title() for w in words[1:])

    forms = (
        lambda: "_".join(names()),
        lambda: "_".join(names()).upper(),
        lambda: camel(names()),
        lambda: camel(["", *names()]),
        lambda: "-".join(names()),
        lambda: "/" + "/".join([*names(), date(draw.choice("/-"))][: draw.randint(1, 5)]),
        lambda: "/".join(names(2, 5)),
        lambda: "_".join([*names(1, 2), str(draw.randint(0, 9999))]),
        lambda: str(draw.randrange(10 ** draw.randint(2, 24))),
        lambda: (draw.choice(string.digits) + string.digits * 3)[: draw.randint(4, 24)],
        lambda: date(draw.choice(["-", "/", "_", ""])),
        lambda: date("-") + "T" + time("-") + draw.choice(["", "Z", "-000Z"]),
        uuid,
        lambda: draw.choice(ALPHABET) * draw.randint(4, 30),
    )
    ordinary = [forms[i % len(forms)]() for i in range(DRAWN)]
    rand = ["".join(draw.choice(a) for _ in range(draw.randint(16, 48))) for a in (alphabets[i % len(alphabets)] for i in range(DRAWN))]
    return ordinary, rand


def _counts(strings) -> np.ndarray:
    return np.bincount(transitions(*strings), minlength=SIZE * SIZE).astype(np.int64)


def train(df: DataFrame, text: str = "text", least: float = LEAST_RATIO) -> Model:
    """Both models from every text of ``df``; what reaches the driver is one row a transition.

    A token counts once for each document that has it. Where the corpus has no sample of a label
    (an empty table, or one without secrets) the drawn ones are all there is. Counts of whole
    tables are exact, so the model does not depend on how rows are dealt.
    """
    common.prepare(df.sparkSession)

    def tokens_of(batches):
        held: dict[str, int] = {}
        secret = np.zeros(SIZE * SIZE, np.int64)

        def out():
            columns = [pa.nulls(len(held), pa.int32()), common.strings(list(held)), common.longs(list(held.values()))]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in common.slices(batches):
            for value in batch.column(0).to_pylist():
                ordinary, found = _samples(value)
                for token in ordinary:
                    held[token] = held.get(token, 0) + 1
                if found:
                    secret += _counts(found)
            if len(held) >= COUNTED:
                yield out()
        yield out()
        moves = np.flatnonzero(secret)
        columns = [pa.array(moves, pa.int32()), pa.nulls(len(moves), pa.string()), pa.array(secret[moves])]
        yield pa.RecordBatch.from_arrays(columns, names)

    def moves_of(batches):
        totals = np.zeros(SIZE * SIZE, np.int64)
        for batch in common.slices(batches):
            tokens, documents = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            lengths = np.fromiter((len(t) for t in tokens), np.int64, len(tokens))
            # one token after the other, a transition of each as often as documents have it
            np.add.at(totals, transitions(*tokens), np.repeat(documents, lengths))
        moves = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(moves, pa.int32()), pa.array(totals[moves])], ["move", "n"])

    names = ["move", "token", "n"]
    counted = common.stage(df.select(common.whole(text).alias("t")).mapInArrow(tokens_of, "move int, token string, n long"), "tokens")
    spread = counted.where("token is not null").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= SEVERAL)
    ordinary = spread.mapInArrow(moves_of, "move int, n long").groupBy("move").agg(F.sum("n").alias("n"))
    secret = counted.where("move is not null").groupBy("move").agg(F.sum("n").alias("n"))
    logs = []
    for own, sample in zip((ordinary, secret), drawn_samples()):
        counts = np.zeros(SIZE * SIZE)
        for row in own.collect():
            counts[row.move] = row.n
        drawn = _counts(sample).astype(np.float64)
        if counts.any():
            drawn *= DRAWN_SHARE / (1 - DRAWN_SHARE) * counts.sum() / drawn.sum()
        smooth = (counts + drawn + SMOOTHING).reshape(SIZE, SIZE)
        logs.append(np.log(smooth / smooth.sum(1, keepdims=True)).ravel())
    return Model(tuple((logs[1] - logs[0]).tolist()), least)


def scan(df: DataFrame, model: Model, text: str = "text", spans: str = "spans") -> DataFrame:
    """Every row of ``df`` with its secrets in a new column ``spans``.

    ``spans`` is a list of ``(start, kind, end)`` in code points, end exclusive, ordered by
    start, then kind as in ``KINDS``. Null and empty texts have an empty list. Other columns
    pass through; one already named ``spans`` is replaced.
    """
    kept: list[Scanner] = []
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def run(texts):
        if not kept:
            kept.append(Scanner(model))
        found = [kept[0].spans(t) for t in texts]
        return pa.array(
            [[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in x] for x in found], kind
        )

    return common.append_column(
        df, run, common.whole(text), spans, "array<struct<start:bigint,kind:string,end:bigint>>"
    )


def blank(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    parts, at = [], 0
    for start, _, stop in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, stop)
    return "".join([*parts, text[at:]])


def redacted(df: DataFrame, model: Model, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """Every row of ``df``, its secrets replaced by ``mark``; a null text stays null."""
    kept: list[Scanner] = []

    def run(texts):
        if not kept:
            kept.append(Scanner(model))
        return common.strings(
            [t if t is None else blank(t, kept[0].spans(t), mark) for t in texts]
        )

    changed = common.append_column(df, run, F.col(f"`{text}`"), text, "string")
    return changed.select(*[F.col(f"`{c}`") for c in df.columns])


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(documents, train(documents)).select("doc_id", "spans")

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
