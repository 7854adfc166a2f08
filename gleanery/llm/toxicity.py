"""Toxicity by a weighted lexicon, matched by one Aho-Corasick pass over folded text.

Folding is by compatibility decomposition without marks and format characters, so accents,
full-width, mathematical and circled letters and zero-width characters inside a word change
nothing; then letters that look like Latin ones, and digits or signs, also several in a row,
that stand for letters. A 1 or a bar is read as i and, in a second pass, as l; that pass
leaves signs before a word alone. Hits are given in positions of the text. An entry
is a whole word or, ending in ``*``, the start of words or, ending in ``+``, a stem with an
ending of up to ``ENDING_CHARS`` letters. Hits inside an exception phrase do not count. A word counts once, with its heaviest entry. The sum of weights and that sum for
each word of the text enter a logistic model.

Weights are learned from labelled texts, a bounded sample of them: the log odds of a word,
or of a start of words, among toxic against other texts, where its share among toxic texts
is beyond chance: the evidence, in nats, exceeds the logarithm of how many terms of its kind
were looked at by ``MARGIN``. Entries of ``BASE_WORDS`` are in the lexicon without any label.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass
from math import exp, log, log1p

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common

#: Labelled texts that the lexicon and the model are fitted on, at most.
LEARN_ROWS = 8000
#: Lengths of word starts that may become entries.
START_CHARS = (3, 4, 5, 6, 7, 8)
#: Longest ending of a stem.
ENDING_CHARS = 5
#: Entries need this log odds, and this many toxic texts.
LEAST_ODDS = 3.0
LEAST_TOXIC = 3
#: Three nats: among terms that mean nothing, one entry is expected in twenty lexicons.
MARGIN = 3.0
#: Terms whose counts a task holds before it passes them on.
HELD_TERMS = 100_000
#: Score from which a text is called toxic.
THRESHOLD = 0.3
BASE_WEIGHT = 4.0
BASE_WORDS = (
    "bastard", "bitch*", "crap", "cretin", "douchebag", "dumbass", "dumb", "fuck*", "idiot*",
    "imbecile", "jerk", "loser", "losers", "moron*", "pathetic", "scum", "scumbag", "shit*",
    "stupid*", "trash", "vermin", "worthless", "disgusting", "clown", "asshole*",
)
#: Phrases in which an entry means no harm.
EXCEPTIONS = (
    "trash can", "trash bin", "trash collection", "clown fish", "clownfish", "idiot proof",
    "pond scum", "sore loser rule", "circus clown", "crap game", "jerk chicken", "jerk seasoning",
)

#: Letters that look like Latin ones: Greek and Cyrillic, small and capital, and dotless i.
LOOKALIKES = dict(zip("αβεικνορτυχаеорсухіјѕԁвнкмтіАВЕКМНОРСТУХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧı",
                      "abeiknoptuxaeopcyxijsdbhkmtiabekmhopctyxijsabezhikmnoptyxi"))
DIGITS = {"0": "o", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "+": "t"}
#: Combining marks that are dropped, and letters A to Z in boxes and discs, as code points.
MARKS = ((0x300, 0x36F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE20, 0xFE2F))
BOXED = (0x1F130, 0x1F150, 0x1F170, 0x1F1E6)

_SIGNS = str.maketrans(SIGNS)
_SIGNS_L = str.maketrans(SIGNS | {"|": "l"})
_SIGN = re.compile(r"[@$!|+]+(?=\w)")
_INNER_SIGN = re.compile(r"(?<=\w)[@$!|+]+(?=\w)")
_WORD = re.compile(r"\w+")


def _dropped(letter: str) -> bool:
    return unicodedata.category(letter) == "Cf" or any(a <= ord(letter) <= b for a, b in MARKS)


class _Folds(dict):
    """What each code point folds to, found when it is first met; "" if it is dropped.

    A 1 stays, and so do signs: they depend on how the text is read.
    """

    def __missing__(self, point: int) -> str:
        letter = chr(point)
        for first in BOXED:
            if first <= point < first + 26:
                letter = chr(ord("a") + point - first)
        # lookalikes before case: some capitals look like another letter than their small ones
        known = LOOKALIKES.get(letter)
        base = [c for c in unicodedata.normalize("NFKD", letter) if not _dropped(c)]
        plain = "".join(LOOKALIKES.get(c, c) for c in base).lower()
        if known is None and len(base) > 1 and not plain.isascii():
            known = letter.lower()[:1]  # not a Latin letter with marks: kept in one piece
        elif known is None:
            known = "".join(DIGITS.get(c, c) for c in plain)
        self[point] = known
        return known


_FOLDS = _Folds()


def readings(text: str) -> list[str]:
    """The text as entries are looked for in it, and a second reading if there is one.

    Both have the same length, which need not be that of the text.
    """
    plain = text.translate(_FOLDS)
    signs = _SIGN.search(plain) is not None
    if not signs and "1" not in plain:
        return [plain]
    first = other = plain
    if signs:
        first = _SIGN.sub(lambda m: m[0].translate(_SIGNS), plain)
        other = _INNER_SIGN.sub(lambda m: m[0].translate(_SIGNS_L), plain)
    return [first.replace("1", "i"), other.replace("1", "l")]


def fold(text: str) -> str:
    """The first reading of a text."""
    return readings(text)[0]


def places(text: str) -> list[int]:
    """For each place of the folded text, and its end, the place in ``text`` it comes from."""
    sizes = [len(_FOLDS[ord(c)]) for c in text]
    return [i for i, n in enumerate(sizes) for _ in range(n)] + [len(text)]


@dataclass(frozen=True)
class Model:
    """Weights by entry and the logistic model over the two sums."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -5.0
    total: float = 1.0
    density: float = 1.0


class Matcher:
    """The compiled lexicon of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.search = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        for entry, weight in model.weights.items():
            tail = {"*": None, "+": ENDING_CHARS}.get(entry[-1:], 0)
            word = fold(entry if tail == 0 else entry[:-1])
            if word:
                entries.setdefault(word, []).append((weight, tail))
        for phrase in model.exceptions:
            entries.setdefault(fold(phrase), []).append((None, 0))
        for word, uses in entries.items():
            self.search.add_word(word, (len(word), tuple(uses)))
        self.empty = not entries
        if entries:
            self.search.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """``(start, end, weight)`` of every counted hit, in code points of ``text``."""
        found = self._folded_hits(text)
        if not found or text.isascii():
            return found
        at = places(text)
        return [(at[a], at[b - 1] + 1, w) for a, b, w in found]

    def _folded_hits(self, text: str) -> list[tuple[int, int, float]]:
        """The hits, in places of the folded text."""
        if self.empty:
            return []
        best, excused = {}, []
        for folded in readings(text):
            self._look(folded, best, excused)
        counted = [(a, b, w) for a, (b, w) in sorted(best.items())]
        if excused:
            counted = [x for x in counted if not any(a <= x[0] and x[1] <= b for a, b in excused)]
        return counted

    def _look(self, folded: str, best: dict, excused: list) -> None:
        last = len(folded)
        for end, (size, uses) in self.search.iter(folded):
            start, stop = end + 1 - size, end + 1
            if start and folded[start - 1].isalnum():
                continue
            more = 0  # letters up to the word's end, as far as they matter
            while more <= ENDING_CHARS and stop + more < last and folded[stop + more].isalnum():
                more += 1
            for weight, tail in uses:
                if tail is not None and more > tail:
                    continue
                if weight is None:
                    excused.append((start, stop))
                elif start not in best or best[start][1] < weight:
                    best[start] = (stop, weight)

    def sums(self, text: str) -> tuple[float, float]:
        """The two features: sum of weights, and the same for each 100 words, as logarithms."""
        total = sum(w for _, _, w in self._folded_hits(text))
        if not total:
            return 0.0, 0.0
        return log1p(total), log1p(100 * total / (1 + text.count(" ") + text.count("\n")))

    def score(self, text: str) -> float:
        total, density = self.sums(text)
        z = self.model.bias + self.model.total * total + self.model.density * density
        return 1 / (1 + exp(-z)) if z > -700 else 0.0


def _terms(text: str) -> set[str]:
    words = set(_WORD.findall(fold(text)))
    starts = {f"{w[:n]}*" for w in words for n in START_CHARS if len(w) >= n}
    stems = {f"{w[:n]}+" for w in words for n in START_CHARS if n <= len(w) <= n + ENDING_CHARS}
    return words | starts | stems


def _counted(rows: DataFrame) -> DataFrame:
    """``(term, toxic, other)``: in how many texts of each label it occurs."""
    common.prepare(rows.sparkSession)

    def counted(label, counts):
        columns = [pa.array([label] * len(counts), pa.bool_()), common.strings([*counts]), common.longs([*counts.values()])]
        return pa.RecordBatch.from_arrays(columns, ["label", "term", "n"])

    def count(batches):
        counts = {True: Counter(), False: Counter()}
        for batch in common.slices(batches):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(_terms(text))
                if len(counts[label]) >= HELD_TERMS:
                    yield counted(label, counts[label])
                    counts[label].clear()
        for label, own in counts.items():
            yield counted(label, own)

    counts = rows.mapInArrow(count, "label boolean, term string, n long").groupBy("term")
    return counts.agg(
        F.sum(F.when(F.col("label"), F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label"), 0).otherwise(F.col("n"))).alias("other"),
    )


def learning_rows(
    df: DataFrame, labels: DataFrame, learnable: Column, text: str, id: str, label: str, most: int
) -> DataFrame:
    """Up to ``most`` different labelled texts, picked by a hash of the id: ``(text, label)``."""
    own = labels.where(learnable & F.col(label).isNotNull()).select(
        F.col(id).alias("id"), (F.col(label) == 1).alias("label")
    )
    picked = own.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(most)
    rows = df.select(F.col(f"`{id}`").alias("id"), common.whole(text).alias("text"))
    return rows.join(picked, "id").groupBy("text").agg(F.max("label").alias("label"))


def learn(
    df: DataFrame,
    labels: DataFrame,
    learnable: Column,
    *,
    text: str = "text",
    id: str = "doc_id",
    label: str = "toxic",
    most: int = LEARN_ROWS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Model:
    """A model from the labelled rows of ``labels`` for which ``learnable`` holds.

    At most ``most`` labelled texts are read, each different text once; what reaches the
    driver is bounded by them: entries that at least ``LEAST_TOXIC`` of them have, and two
    numbers for each.
    Without any toxic label, or without any other, the base lexicon is used as it is.
    """
    base = dict.fromkeys(BASE_WORDS, BASE_WEIGHT)
    rows = common.stage(learning_rows(df, labels, learnable, text, id, label, most), "learn")
    seen = {bool(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, other = seen.get(True, 0), seen.get(False, 0)
    if not toxic or not other:
        return Model(base, exceptions)
    share = toxic / (toxic + other)
    own = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("other") + 0.5) / (other + 1))
    # nats by which the counts speak against the share that all texts have
    part = F.col("toxic") / (F.col("toxic") + F.col("other"))
    evidence = F.col("toxic") * F.log(part / share) + F.col("other") * F.when(
        F.col("other") > 0, F.log((1 - part) / (1 - share))
    ).otherwise(0.0)
    kind = F.when(F.col("term").rlike("[*+]$"), F.concat(F.right("term", F.lit(1)), F.length("term")))
    tried = common.stage(
        _counted(rows)
        .where(F.col("toxic") >= LEAST_TOXIC)
        .select("term", F.coalesce(kind, F.lit("")).alias("kind"), own.alias("weight"), evidence.alias("evidence")),
        "terms",
    )
    chance = tried.groupBy("kind").agg((F.log(F.count("*")) + MARGIN).alias("least"))  # a row for each kind
    found = tried.join(chance, "kind").where(
        (F.col("weight") >= LEAST_ODDS) & (F.col("evidence") > F.col("least"))
    )
    weights = base | {r.term: r.weight for r in found.select("term", "weight").collect()}
    fitted = common.map_batches(rows, _features(Model(weights, exceptions)), "total double, density double, label boolean")
    values = fitted.toPandas().sort_values(["total", "density", "label"])  # sums don't depend on tasks
    bias, total, density = _logistic(
        values[["total", "density"]].to_numpy(float), values["label"].to_numpy(float)
    )
    return Model(weights, exceptions, bias, total, density)


def _features(model: Model):
    """Features of a batch; the automaton is compiled once in each task."""
    kept: list[Matcher] = []

    def sums(batch):
        if not kept:
            kept.append(Matcher(model))
        values = [kept[0].sums(t) for t in batch.column(0).to_pylist()]
        return [*(pa.array([v[i] for v in values], pa.float64()) for i in (0, 1)), batch.column(1)]

    return sums


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[float, float, float]:
    """Newton's method with a small penalty; weights never below zero."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(3), np.array([1e-3, ridge, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), max(0.0, float(w[1])), max(0.0, float(w[2]))


def scores(df: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Every row of ``df`` with its score from 0 to 1 in a new column ``score``.

    Null and empty texts have the score of a text without hits. Texts are read whole. Other
    columns pass through; one already named ``score`` is replaced. Repeated rows score alike.
    """
    kept: list[Matcher] = []

    def run(texts):
        if not kept:
            kept.append(Matcher(model))
        return pa.array([kept[0].score(t) for t in texts], pa.float64())

    return common.append_column(df, run, common.whole(text), score, "double")


def accepted(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose score is below ``threshold``, all columns as they are."""
    kept: list[Matcher] = []

    def run(texts):
        if not kept:
            kept.append(Matcher(model))
        return [kept[0].score(t) < threshold for t in texts]

    return common.keep_rows(df, run, common.whole(text))


def held_out(id: str = "doc_id") -> Column:
    """Rows that labels are never learned from."""
    return F.crc32(F.col(id).cast("string")) % 4 == 2


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learned from the labelled ones that are not held out."""
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(documents, common.table(spark, sf_dir, "labels"), ~held_out())
    scored = scores(documents, model).select("doc_id", held_out().alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
