"""Document fingerprints by I-Match over randomised lexicons.

The lexicon is every term whose inverse document frequency lies in a band, and all terms of
documents that have only terms too frequent for it, such as copies of one text. A document's
terms in it, distinct and sorted, are hashed as a whole and for each of several random
subsets of the lexicon. Subsets keep a quarter of the lexicon down to one term in 1024, so
that for short and long documents some of them change and some don't when a part of the
text does. From which subsets agree, and which are empty on both sides, the likeness of two
documents is estimated: the most likely share of their terms that both have.

How large the lexicon gets doesn't depend on the corpus: document frequencies add up to the
distinct terms of all documents, so at most (mean distinct terms) * exp(``IDF_HIGH``) terms
occur in one of exp(``IDF_HIGH``) documents or more.
"""

from __future__ import annotations

import string
from collections import Counter
from math import exp

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common

#: The band of ln(documents / documents with the term).
IDF_LOW, IDF_HIGH = 2.0, 6.9
#: A subset keeps a term with each of these probabilities; so many subsets of each.
RATES = (1 / 4, 1 / 16, 1 / 64, 1 / 256, 1 / 1024)
SUBSETS = 12
SEED = 7_919
#: Digits of a subset's hash, and that of a subset without any term.
DIGITS = 8
EMPTY = "0" * DIGITS


_MARKS = string.punctuation.encode()


def terms(text: str) -> list[bytes]:
    """Lower-case words in UTF-8 without ASCII punctuation, repeats included."""
    return text.lower().encode("utf-8", "surrogatepass").translate(None, _MARKS).split()


class Lexicon:
    """Sorted terms, with a hash and the bits of the subsets that have it for each."""

    def __init__(self, words: list[str]):
        raw = sorted(w.encode("utf-8", "surrogatepass") for w in words)
        self.number = {w: i for i, w in enumerate(raw)}
        self.hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in raw], np.uint64)
        self.member = np.zeros((len(words), len(RATES) * SUBSETS), bool)
        for subset in range(self.member.shape[1]):
            # 32 bits of a hash of the term and the subset, against the rate
            draw = (self.hashes + np.uint64(subset + 1)) * np.uint64(0x9E3779B97F4A7C15)
            draw = (draw ^ (draw >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            self.member[:, subset] = (draw >> np.uint64(32)) < np.uint64(RATES[subset // SUBSETS] * 2**32)

    def fingerprint(self, text: str) -> str:
        """The hash over all terms, then one for each subset; equal for equal texts.

        A text without any term in the lexicon has the hash of the whole text and only empty
        subsets.
        """
        own = sorted(self.number[w] for w in set(terms(text)) & self.number.keys())
        if not own:
            return f"{xxhash.xxh64_hexdigest(text.encode('utf-8', 'surrogatepass'), SEED)}{EMPTY * (len(RATES) * SUBSETS)}"
        hashes = self.hashes[own]
        # members of every subset, one subset after another, each in the order of terms
        subsets, places = np.nonzero(self.member[own].T)
        members = hashes[places].tobytes()
        ends = (8 * np.searchsorted(subsets, np.arange(len(RATES) * SUBSETS + 1))).tolist()
        digest = xxhash.xxh32_hexdigest
        parts = [digest(members[a:b], SEED) if b > a else EMPTY for a, b in zip(ends, ends[1:])]
        return xxhash.xxh64_hexdigest(hashes.tobytes(), SEED) + "".join(parts)


def _likelihoods() -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of one subset being both empty, agreeing or differing, by rate.

    Rows: rate and outcome; columns: a grid of how many terms two documents have together
    and which share of them both have.
    """
    together = np.exp(np.linspace(np.log(1), np.log(50_000), 30))
    share = np.linspace(0, 1, 21)
    grid_n, grid_s = (x.ravel() for x in np.meshgrid(together, share, indexing="ij"))
    table = np.empty((len(RATES), 3, grid_n.size))
    for i, rate in enumerate(RATES):
        empty, same = (1 - rate) ** grid_n, (1 - rate) ** (grid_n * (1 - grid_s))
        for k, p in enumerate((empty, same - empty, 1 - same)):
            table[i, k] = np.log(np.clip(p, 1e-9, 1))
    return table.reshape(3 * len(RATES), -1), grid_s


_TABLE, _SHARE = _likelihoods()


def likeness(pairs: list[tuple[str, str]]) -> list[float]:
    """The likeness, from 0 to 1, of each pair of fingerprints; 1 for equal ones.

    Fingerprints whose subsets are all empty on one side or the other, or none of which
    agree, are not alike at all.
    """
    if not pairs:
        return []
    size = len(RATES) * SUBSETS
    a, b = (np.array([p[i].encode() for p in pairs], f"S{16 + DIGITS * size}") for i in (0, 1))
    a, b = (x.view("S1").reshape(len(pairs), -1)[:, 16:].copy().view(f"S{DIGITS}") for x in (a, b))
    nothing = EMPTY.encode()
    both_empty = (a == nothing) & (b == nothing)
    agree = (a == b) & ~both_empty
    outcomes = np.stack([both_empty, agree, ~(both_empty | agree)], 2)
    counts = outcomes.reshape(len(pairs), len(RATES), SUBSETS, 3).sum(2).reshape(len(pairs), -1)
    values = np.empty(len(pairs))
    for start in range(0, len(pairs), 256):
        best = (counts[start : start + 256] @ _TABLE).argmax(1)
        values[start : start + 256] = _SHARE[best]
    values[~agree.any(1)] = 0.0
    return [1.0 if x == y else float(v) for (x, y), v in zip(pairs, values)]


def _frequent_terms(df: DataFrame, text: str) -> tuple[list[str], list[str]]:
    """The terms of ``df`` within the band, and those that are too frequent for it.

    A term frequent enough in the corpus is frequent enough in some part of it: a first pass
    finds the terms that are so in some task's rows, a second one counts these everywhere.
    Both move a few terms of each task only.
    """
    common.prepare(df.sparkSession)
    rows = df.select(common.whole(text).alias("t"))
    least, most = exp(-IDF_HIGH), exp(-IDF_LOW)

    def counted(batches, only=None):
        counts, n = Counter(), 0
        for batch in common.slices(batches):
            n += batch.num_rows
            for value in batch.column(0).to_pylist():
                own = set(terms(value))
                counts.update(own if only is None else own & only)
        return counts, n

    def frequent(batches):
        counts, n = counted(batches)
        words = [w.decode("utf-8", "surrogatepass") for w, c in counts.items() if c >= least * n]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], ["term"])

    candidates = rows.mapInArrow(frequent, "term string").distinct()
    wanted = df.sparkSession.sparkContext.broadcast(
        {w.encode("utf-8", "surrogatepass") for w in candidates.toArrow().column(0).to_pylist()}
    )

    def exact(batches):
        counts, n = counted(batches, wanted.value)
        words = [w.decode("utf-8", "surrogatepass") for w in counts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*words, None], pa.string()), common.longs([*counts.values(), n])],
            ["term", "n"],
        )

    totals = common.stage(
        rows.mapInArrow(exact, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")), "terms"
    )
    documents = totals.where("term is null").agg(F.sum("n")).first()[0] or 0
    kept = totals.where(F.col("term").isNotNull() & (F.col("n") >= least * documents))
    found = kept.select("term", (F.col("n") <= most * documents).alias("within")).collect()
    return [r.term for r in found if r.within], [r.term for r in found if not r.within]


def lexicon_terms(df: DataFrame, text: str = "text") -> list[str]:
    """The terms of ``df`` within the band, counted over all rows (null texts as empty ones)."""
    return _frequent_terms(df, text)[0]


def full_lexicon(df: DataFrame, text: str = "text") -> list[str]:
    """The terms within the band, and all terms of the texts that have frequent terms only.

    Of a text that a third of all rows hold, no term is rare enough for the band; nor need one
    be of a short text. Terms below the band are too rare for the lexicon in any case. Those
    above it are at most (mean distinct terms) * exp(``IDF_LOW``), whatever the corpus.
    """
    words, above = _frequent_terms(df, text)
    if not above:
        return words
    shared = df.sparkSession.sparkContext.broadcast(
        tuple({w.encode("utf-8", "surrogatepass") for w in x} for x in (words, above))
    )

    def left_out(batches):
        within, frequent = shared.value
        found: set[bytes] = set()
        for batch in common.slices(batches):
            for value in batch.column(0).to_pylist():
                # nearly all have a term of the band among their first words
                if not within.isdisjoint(terms(value[: max(0, value.rfind(" ", 0, 400))])):
                    continue
                own = set(terms(value))
                if within.isdisjoint(own):
                    found |= own & frequent
        more = [w.decode("utf-8", "surrogatepass") for w in found]
        yield pa.RecordBatch.from_arrays([pa.array(more, pa.string())], ["term"])

    more = df.select(common.whole(text).alias("t")).mapInArrow(left_out, "term string").distinct()
    return words + [r.term for r in more.collect()]


def fingerprints(
    df: DataFrame, words: list[str], text: str = "text", name: str = "fingerprint"
) -> DataFrame:
    """Every row with the fingerprint of its whole text in a new column; null texts are empty.

    Other columns pass through; one of that name is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(words)
    kept: list[Lexicon] = []

    def run(texts):
        if not kept:
            kept.append(Lexicon(shared.value))
        return common.strings([kept[0].fingerprint(t) for t in texts])

    return common.append_column(df, run, common.whole(text), name, "string")


def in_order(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(id, t, guest)``, dealt and sorted so that in a partition each row's next follows it.

    The order is by id descending, nulls last, then by text descending. Ids are cut into
    ranges; to each range the first row of the next one comes as a guest, to the last that of
    the first. Texts move once. Rows of one id stay in one range.
    """
    rows = df.select(F.col(f"`{id}`").cast("long").alias("id"), common.whole(text).alias("t"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    bounds = sorted(set(rows.agg(F.percentile_approx("id", shares, 10_000)).first()[0] or []))
    # ranges in the order of rows: the highest ids are range 0, nulls the last one
    edges = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    span = F.when(F.col("id").isNull(), F.lit(len(bounds) + 1)).otherwise(
        F.size(F.filter(edges, lambda b: b > F.col("id")))
    )
    ranged = rows.withColumn("span", span)
    firsts = ranged.groupBy("span").agg(F.max("id").alias("first")).orderBy("span").collect()
    if not firsts:
        return ranged.select("id", "t", F.lit(False).alias("guest"), "span")
    # one row a range: which range gets whose first row
    goes = df.sparkSession.createDataFrame(
        [(firsts[i].span, firsts[i].first, firsts[i - 1].span) for i in range(len(firsts))],
        "own int, first long, guest_of int",
    )
    heads = ranged.join(
        F.broadcast(goes), (F.col("span") == F.col("own")) & F.col("id").eqNullSafe(F.col("first"))
    )
    guests = heads.groupBy("id", "guest_of").agg(F.max("t").alias("t")).select(
        "id", "t", F.lit(True).alias("guest"), F.col("guest_of").alias("span")
    )
    dealt = ranged.select("id", "t", F.lit(False).alias("guest"), "span").unionByName(guests)
    return dealt.repartition(parts, "span").sortWithinPartitions(
        "span", "guest", F.col("id").desc_nulls_last(), F.desc("t")
    )


def with_next(df: DataFrame, words: list[str], text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next)``.

    One row for every row of ``df``; the next row is as in ``in_order``, of a single row
    itself. ``edited`` is the text whose last third (rounded down) is replaced by as many
    characters of the next one's beginning, or all if it has fewer. Repeated rows follow one
    another. An empty table has no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(words)
    kept: list[Lexicon] = []
    common.prepare(df.sparkSession)
    names = ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        if not kept:
            kept.append(Lexicon(shared.value))
        tool, held = kept[0], None

        for batch in common.slices(batches):
            ids, sizes, texts, own, other, following = [], [], [], [], [], []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for number, value, guest, span in zip(*columns):
                print_ = tool.fingerprint(value)
                if held is not None and held[3] == span:
                    n = len(held[1])
                    edited = held[1][: n - n // 3] + value[: n // 3]
                    ids.append(held[0])
                    sizes.append(n)
                    texts.append(edited)
                    own.append(held[2])
                    other.append(tool.fingerprint(edited))
                    following.append(print_)
                held = None if guest else (number, value, print_, span)
            yield pa.RecordBatch.from_arrays(
                [
                    common.longs(ids), common.longs(sizes), common.strings(texts),
                    common.strings(own), common.strings(other),
                    pa.array(likeness(list(zip(own, other))), pa.float64()),
                    pa.array(likeness(list(zip(own, following))), pa.float64()),
                ],
                names,
            )

    return in_order(df, text, id).mapInArrow(
        run,
        "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_next(documents, full_lexicon(documents))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
