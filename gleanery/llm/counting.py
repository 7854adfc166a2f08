"""Token counts that follow edits.

A text is split into pre-tokens; each has a length and a number of tokens. A segment tree
over them holds both sums for every subtree. An edit descends the tree by length to the
pre-tokens it touches, splits and encodes anew only those and a few around them, and
updates the sums on the way up.

How far around: a pre-token's end depends on the two characters after it at most, so
splitting starts again two pre-tokens before the edit. It goes on until a new boundary
behind the edit falls on an old one; the rest of the text is then split as before.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import bpe, common, packing

#: Pre-tokens before an edit that are split anew.
BEFORE = 2
#: Words whose count a worker remembers.
REMEMBERED = 500_000
_SPLIT = regex.compile(bpe.SPLIT)
_ASCII_SPLIT = re.compile(bpe.ASCII_SPLIT, re.ASCII)
EDITS = "array<struct<start:bigint,removed:bigint,inserted:string>>"


def split(text: str) -> list[str]:
    """The pre-tokens of a text."""
    return (_ASCII_SPLIT if text.isascii() else _SPLIT).findall(text)


class Counter:
    """Tokens of single pre-tokens."""

    def __init__(self, ranks: bytes):
        self.encode = packing.encoder(ranks).encode_ordinary
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> list[int]:
        counts = list(map(self.known.get, words))
        if None in counts:
            for i, n in enumerate(counts):
                if n is None:
                    counts[i] = n = len(self.encode(words[i]))
                    if len(words[i]) <= bpe.REMEMBERED_CHARS:
                        if len(self.known) >= REMEMBERED:
                            self.known.clear()
                        self.known[words[i]] = n
        return counts


@lru_cache(maxsize=2)
def counter(ranks: bytes) -> Counter:
    return Counter(ranks)


class Tree:
    """Sums of lengths and counts over pre-tokens; a leaf holds what one became by edits."""

    def __init__(self, lengths: Iterable[int], counts: Iterable[int]):
        self.leaves = 1 << max(0, len(lengths) - 1).bit_length()
        self.given = np.asarray(lengths, np.int32), np.asarray(counts, np.int32)
        self.own: dict[int, tuple[list[int], list[int]]] = {}
        level = np.zeros((2, self.leaves), np.int64)
        level[0, : len(lengths)], level[1, : len(counts)] = lengths, counts
        levels = [level]
        while level.shape[1] > 1:
            level = level[:, ::2] + level[:, 1::2]
            levels.append(level)
        sums = np.concatenate([np.zeros((2, 1), np.int64), *levels[::-1]], 1)
        self.length, self.count = sums.tolist()

    def leaf(self, i: int) -> tuple[list[int], list[int]]:
        """Lengths and counts of the pre-tokens in leaf ``i``."""
        if i in self.own:
            return self.own[i]
        node = self.leaves + i
        return ([self.length[node]], [self.count[node]]) if self.length[node] else ([], [])

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and counts of all pre-tokens, from the given ones and the changed leaves."""
        if not self.own:
            return self.given
        out, at = ([], []), 0
        for i in sorted(self.own):
            for part, given, own in zip(out, self.given, self.own[i]):
                part += [given[at:i], np.array(own, np.int32)]
            at = i + 1
        for part, given in zip(out, self.given):
            part.append(given[at:])
        return np.concatenate(out[0]), np.concatenate(out[1])

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds the character at ``position``, and where the leaf starts."""
        node, start = 1, 0
        while node < self.leaves:
            node *= 2
            if position >= start + self.length[node]:
                start += self.length[node]
                node += 1
        return node - self.leaves, start

    def put(self, i: int, lengths: list[int], counts: list[int]) -> None:
        self.own[i] = (lengths, counts)
        node = self.leaves + i
        more = sum(lengths) - self.length[node], sum(counts) - self.count[node]
        while node:
            self.length[node] += more[0]
            self.count[node] += more[1]
            node >>= 1

    def filled_before(self, i: int) -> int:
        """The nearest leaf before ``i`` that has a pre-token, -1 if none."""
        return self._near(i, 1)

    def filled_after(self, i: int) -> int:
        """The nearest leaf after ``i`` that has a pre-token, -1 if none."""
        return self._near(i, 0)

    def _near(self, i: int, side: int) -> int:
        # up to a subtree on that side with characters, then down to its near edge
        node = self.leaves + i
        while node > 1 and not ((node & 1) == side and self.length[node ^ 1]):
            node >>= 1
        if node <= 1:
            return -1
        node ^= 1
        while node < self.leaves:
            near = 2 * node + side
            node = near if self.length[near] else near ^ 1
        return node - self.leaves


class Counted:
    """A text with its tree; edits change both and tell how much was encoded."""

    def __init__(self, text: str, lengths: Iterable[int], counts: Iterable[int], count: Counter):
        self.text, self.count, self.tree = text, count, Tree(lengths, counts)

    @property
    def tokens(self) -> int:
        return self.tree.count[1]

    def edit(self, start: int, removed: int, inserted: str) -> int:
        """Replace ``removed`` characters at ``start`` by ``inserted``; pre-tokens encoded.

        Positions outside the text are moved to its ends.
        """
        tree, old = self.tree, self.text
        start = min(max(start, 0), len(old))
        stop = min(start + max(removed, 0), len(old))
        self.text = new = old[:start] + inserted + old[stop:]
        if not old:
            words = _SPLIT.findall(new)
            tree.put(0, list(map(len, words)), self.count(words))
            return len(words)
        leaf, at = tree.find(max(start - 1, 0))
        # to the start of pre-tokens BEFORE the one that ends at the edit
        before = sum(1 for e in accumulate(tree.leaf(leaf)[0]) if at + e < start)
        while before < BEFORE and (near := tree.filled_before(leaf)) >= 0:
            leaf = near
            at -= tree.length[tree.leaves + leaf]
            before += len(tree.leaf(leaf)[0])
        # old pre-tokens from here on are used up leaf by leaf until a boundary agrees
        lengths, counts, words = [], [], []
        moved, edited_to = len(new) - len(old), start + len(inserted)
        used, used_to = [leaf], at + tree.length[tree.leaves + leaf]
        ends, last = set(accumulate(tree.leaf(leaf)[0], initial=at)), leaf
        position = at
        matches = _SPLIT.finditer(new, at)
        while position < len(new):
            if position >= edited_to and position - moved >= stop:
                while used_to < position - moved:
                    last = tree.filled_after(last)
                    used.append(last)
                    own = tree.leaf(last)[0]
                    ends.update(accumulate(own, initial=used_to))
                    used_to += sum(own)
                if position - moved in ends:
                    break
            word = next(matches)[0]
            words.append(word)
            position += len(word)
        reach = max(position - moved, stop)
        while used_to < reach:
            last = tree.filled_after(last)
            used.append(last)
            used_to += tree.length[tree.leaves + last]
        lengths, counts = list(map(len, words)), self.count(words)
        # what the last used leaf has behind the agreed boundary stays as it is
        own_lengths, own_counts = tree.leaf(last)
        edge = used_to - sum(own_lengths)
        for own, n in zip(own_lengths, own_counts):
            if edge >= reach:
                lengths.append(own)
                counts.append(n)
            edge += own
        for i in used[1:]:
            tree.put(i, [], [])
        tree.put(leaf, lengths, counts)
        return len(words)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*arrays, np.zeros(0, np.int32)]).astype(np.int32)))


def index(df: DataFrame, ranks: bytes, text: str = "text") -> DataFrame:
    """Every row with ``lengths`` and ``counts``: characters and tokens of its pre-tokens.

    These are the leaves of its tree, to be kept with the text. A null text counts as empty.
    Other columns pass through; ones of those names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(texts):
        count = counter(shared.value)
        lengths, counts = [], []
        for text in texts:
            words = split(text)
            lengths.append(np.fromiter(map(len, words), np.int32, len(words)))
            counts.append(np.array(count(words), np.int32))
        return pa.StructArray.from_arrays([_lists(lengths), _lists(counts)], ["lengths", "counts"])

    name = common.fresh(df, "tree")
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("lengths", "counts")]
    made = common.append_column(
        df, run, common.whole(text), name, "struct<lengths:array<int>,counts:array<int>>"
    )
    return made.select(*kept, F.col(f"`{name}`.lengths"), F.col(f"`{name}`.counts"))


def recount(df: DataFrame, ranks: bytes, edits: Column, text: str = "text") -> DataFrame:
    """Rows of ``index`` after ``edits``: text, lengths and counts are those of the edited text.

    ``edits`` is a list of ``(start, removed, inserted)``, each in code points of the text as
    the ones before it left it; a null list, or null parts, change nothing. Added columns,
    replacing such: ``n_tokens`` before, ``edited_tokens`` after, ``n_encoded`` pre-tokens that were encoded.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    kind = pa.struct([
        ("text", pa.string()), ("lengths", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
        ("n_tokens", pa.int64()), ("edited_tokens", pa.int64()), ("n_encoded", pa.int64()),
    ])

    def run(given):
        count = counter(shared.value)
        columns = [given.field(i) for i in range(4)]
        rows = zip(
            columns[0].to_pylist(), common.arrays_of(columns[1]), common.arrays_of(columns[2]),
            columns[3].to_pylist(),
        )
        out = []
        for value, lengths, counts, changes in rows:
            own, encoded = Counted(value, lengths, counts, count), 0
            before = own.tokens
            for change in changes or ():
                if change is not None:
                    encoded += own.edit(change["start"] or 0, change["removed"] or 0, change["inserted"] or "")
            out.append((own.text, *own.tree.arrays(), before, own.tokens, encoded))
        fields = [
            _lists([r[i] for r in out]) if i in (1, 2) else pa.array([r[i] for r in out], kind[i].type)
            for i in range(len(kind))
        ]
        return pa.StructArray.from_arrays(fields, [f.name for f in kind])

    name = common.fresh(df, "edited")
    source = F.struct(common.whole(text).alias("text"), "lengths", "counts", edits.cast(EDITS).alias("edits"))
    made = common.append_column(
        df, run, source, name,
        "struct<text:string,lengths:array<int>,counts:array<int>,n_tokens:bigint,edited_tokens:bigint,n_encoded:bigint>",
        as_list=False,
    )
    new = [text, "lengths", "counts", "n_tokens", "edited_tokens", "n_encoded"]
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in [n.lower() for n in new]]
    parts = [F.col(f"`{name}`.{f.name}").alias(a) for f, a in zip(kind, new)]
    return made.select(*kept, *parts)


def three_edits(text: Column) -> Column:
    """An insertion in the first quarter, a replacement in the middle, a removal behind it.

    What is inserted is the text's own beginning, so the edits are as varied as the corpus.
    """
    n = F.length(text)

    def change(start, removed, inserted):
        return F.struct(
            F.floor(start).alias("start"), F.lit(removed).cast("long").alias("removed"), inserted.alias("inserted")
        )

    return F.array(
        change(n / 4, 0, F.substring(text, 3, 17)),
        change(n / 2, 12, F.substring(text, 1, 9)),
        change(n * 3 / 4, 23, F.lit("")),
    )


def op10_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits."""
    import public_tokenizers

    ranks = packing.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    indexed = index(documents, ranks).withColumn("n_pretokens", F.size("lengths").cast("long"))
    edited = recount(indexed, ranks, three_edits(common.whole()))
    return edited.select(
        "doc_id", "n_pretokens", "n_tokens", "edited_tokens", "n_encoded",
        F.sha2("text", 256).alias("edited_sha256"),
    )
