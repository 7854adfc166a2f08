"""Byte-level BPE by a tokenization automaton.

The automaton reads token labels. It starts as one state with a loop for every byte. Each
merge (u, v) of the vocabulary applies one gadget: the u arcs are led to a copy of their
target that lacks the v arc, and wherever u could be read an arc uv is added, leading to
where v led. What it accepts are exactly the token sequences BPE produces, one for each
byte string. All arcs of one label lead to one state, so a state is kept as the label whose
gadgets made it and the number of the last of them; a copy is the difference from the state
it was copied from, and copying takes constant time and memory.

Encoding walks the arcs over a pre-split word by table look-up: of the vocabulary's tokens that
are found at a position the longest whose arc the state has is taken. Each position of a word is
reached by one path only, so where a walk can't go on it steps back and never returns to that
position; the walk is linear in the word's length. Decoding concatenates the labels of the arcs.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common

#: Fixed value: how byte-level vocabularies split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts of ASCII letters only, where it is quicker.
ASCII_SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
)
#: Words a worker remembers in each of two generations.
REMEMBERED = 120_000
#: Arcs whose look-up a worker remembers.
REMEMBERED_ARCS = 250_000
#: Longest word that is remembered.
REMEMBERED_CHARS = 64
#: Words or ids that are held as Python objects at a time; texts of up to as many characters
#: are split at once.
PIECE = 65_536


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeAutomaton:
    """A deterministic automaton over tokens, compiled from merges in their order."""

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        #: By token: the first of the two it was merged from, and the gadget that made it.
        self.first: list[int] = [-1] * len(labels)
        self.made: list[int] = [-1] * len(labels)
        #: By token: arcs that its gadgets took from its target, with the gadget's number.
        self.cut: list[dict[int, int]] = [{} for _ in labels]
        #: By token: the state its arc led to when it was made, as (token, gadget); None: start.
        self.base: list[tuple[int, int] | None] = [None] * len(labels)
        self.alive = [len(label) == 1 for label in labels]
        for step, (u, v, w) in enumerate(merges):
            self._gadget(step, u, v, w)
        self.ids = {label: i for i, label in enumerate(labels) if self.alive[i]}
        self.lengths = [len(label) for label in labels]
        #: By token: the longest other token that it begins with, or -1.
        self.shorter = [-1] * len(labels)
        #: The tokens' letters as a trie, by node and byte; its nodes' tokens, or -1.
        self._next: dict[int, int] = {}
        self._ends = [-1]
        for label, i in sorted(self.ids.items()):  # shorter ones come before what they begin
            node = 0
            for byte in label:
                if self._ends[node] >= 0:
                    self.shorter[i] = self._ends[node]
                node = self._next.setdefault(node << 8 | byte, len(self._ends))
                if node == len(self._ends):
                    self._ends.append(-1)
            self._ends[node] = i
        self._table: dict[int, bool] = {}

    def _gadget(self, step: int, u: int, v: int, w: int) -> None:
        if not (self.alive[u] and self.alive[v]) or self.alive[w] or not self._arc(u, step, v, step):
            return  # the pair can't occur: no arc to add
        self.base[w] = (v, step)
        self.cut[u][v] = step
        self.first[w], self.made[w], self.alive[w] = u, step, True

    def _arc(self, state: int, until: int, token: int, now: int) -> bool:
        """Whether the state that ``state``'s arc led to before gadget ``until`` has the arc."""
        spine, gone = [], now
        while token >= 0:
            spine.append((token, gone))
            gone, token = self.made[token], self.first[token]
        while True:
            if cut := self.cut[state]:
                for label, gone in spine:
                    # an arc made by the gadget that cuts its first part is made after the cut
                    if (step := cut.get(label)) is not None and step < until and step <= gone:
                        return False
            if self.base[state] is None:
                return True
            state, until = self.base[state]

    def follows(self, last: int, token: int) -> bool:
        """Table look-up: whether the state after ``last`` has an arc for ``token``."""
        key = last * len(self.labels) + token
        found = self._table.get(key)
        if found is None:
            if len(self._table) >= REMEMBERED_ARCS:
                self._table.clear()
            end = len(self.cut) * 2
            found = self._table[key] = self._arc(last, end, token, end)
        return found

    def _longest(self, word: bytes, start: int) -> int:
        """The longest token at a position, or -1."""
        node, found, step, ends = 0, -1, self._next.get, self._ends
        for byte in word[start:]:
            node = step(node << 8 | byte)
            if node is None:
                break
            if ends[node] >= 0:
                found = ends[node]
        return found

    def encode(self, word: bytes) -> list[int]:
        """The labels of the one accepted path that spells ``word``."""
        if len(word) < 2:
            return [self.ids[word]] if word else []
        known, size, lengths, shorter = self._table.get, len(self.labels), self.lengths, self.shorter
        path, at, dead, stop = [], 0, set(), len(word)
        token = self._longest(word, 0)
        while at < stop:
            while token >= 0:
                if at + lengths[token] not in dead:
                    if not path:
                        break
                    there = known(path[-1] * size + token)
                    if there or there is None and self.follows(path[-1], token):
                        break
                token = shorter[token]
            if token >= 0:
                path.append(token)
                at += lengths[token]
                token = self._longest(word, at)
            else:  # no arc leads on; the token that led here gives way to a shorter one
                dead.add(at)
                token = path.pop()
                at -= lengths[token]
        return path


class Codec:
    """Texts to ids and back for a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, vocabulary: str):
        model = (described := json.loads(vocabulary))["model"]
        if model["type"] != "BPE" or (described.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        letters, known = byte_letters(), model["vocab"]
        added = {x["content"]: x["id"] for x in described.get("added_tokens", ())}
        size = 1 + max([*known.values(), *added.values()])
        labels = [b""] * size
        for token, i in known.items():
            labels[i] = bytes(letters[c] for c in token) if token not in added else token.encode()
        pairs = [tuple(x.split(" ") if isinstance(x, str) else x) for x in model["merges"]]
        self.automaton = MergeAutomaton(
            labels, [(known[a], known[b], known[a + b]) for a, b in pairs]
        )
        self.labels = list(labels)
        for token, i in added.items():
            self.labels[i] = token.encode()
        self.added = {t: np.array([i], np.int32).tobytes() for t, i in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.split = regex.compile(SPLIT)
        self.ascii_split = re.compile(ASCII_SPLIT, re.ASCII)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            packed = array("i", self.automaton.encode(word.encode())).tobytes()
        if len(word) <= REMEMBERED_CHARS:
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[word] = packed
        return packed

    def words(self, text: str) -> Iterator[list[str]]:
        """The pre-split words of a text, a long one's a piece at a time."""
        split = self.ascii_split if text.isascii() else self.split
        if len(text) <= PIECE:
            yield split.findall(text)
            return
        matches = split.finditer(text)
        while words := [m[0] for m in islice(matches, PIECE)]:
            yield words

    def pack(self, words: list[str]) -> bytes:
        """Ids of pre-split words as little-endian 32-bit numbers."""
        found = list(map(self.young.get, words))
        place, left = -1, found.count(None)
        for _ in range(left):
            place = found.index(None, place + 1)
            found[place] = self.young.get(words[place]) or self._word(words[place])
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text; added tokens in it are taken first."""
        if self.special is None or not any(t in text for t in self.added):
            return b"".join(map(self.pack, self.words(text)))
        parts = self.special.split(text)
        return b"".join(
            self.added.get(p) or b"".join(map(self.pack, self.words(p))) for p in parts if p
        )

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        """The text that ids spell; a long list's labels are joined a piece at a time."""
        ids = np.asarray(ids, np.int32)
        pieces = (ids[a : a + PIECE].tolist() for a in range(0, len(ids), PIECE))
        return b"".join(b"".join(map(self.labels.__getitem__, p)) for p in pieces).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    """One automaton for each worker process and vocabulary."""
    common.release()
    return Codec(vocabulary)


def read_vocabulary(path: str) -> str:
    """A vocabulary file (about 1.5 MB, whatever the corpus) as text; tasks get it with their code."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _lists(packed: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    values = np.frombuffer(b"".join(packed), np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Every row of ``df`` with the ids of its whole text in a new column ``ids``.

    A null text counts as empty and has an empty list. Other columns pass through as they
    are; a column already named ``ids`` is replaced. Repeated rows stay repeated.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(texts):
        tool = codec(shared.value)
        return _lists([tool.encode(t) for t in texts])

    return common.append_column(df, run, common.whole(text), ids, "array<int>")


def _coded_twice(df: DataFrame, vocabulary: str, text: str, made: str, kind: str, names: tuple[str, str], second):
    """``df`` with columns of the ids and of what ``second`` makes of the codec, the ids and the text.

    Both come from one pass, so that a task has one Python worker and one automaton.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(texts):
        tool = codec(shared.value)
        packed = [tool.encode(t) for t in texts]
        other = [second(tool, np.frombuffer(p, np.int32), t) for p, t in zip(packed, texts)]
        return pa.StructArray.from_arrays([_lists(packed), pa.array(other, made)], ["ids", "other"])

    name = common.fresh(df, "coded")
    coded = common.append_column(df, run, common.whole(text), name, f"struct<ids:array<int>,other:{kind}>")
    taken = [n.lower() for n in names]
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return coded.select(*kept, F.col(f"`{name}`.ids").alias(names[0]), F.col(f"`{name}`.other").alias(names[1]))


def encode_and_check(
    df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", check: str = "round_trip"
) -> DataFrame:
    """``encode``, and in ``check`` whether the ids decode to the whole text again."""

    def same(tool, own, value):
        return tool.decode(own) == value

    return _coded_twice(df, vocabulary, text, pa.bool_(), "boolean", (ids, check), same)


def encode_and_decode(
    df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode``, and in ``decoded`` the text that the ids spell."""

    def spelt(tool, own, value):
        return tool.decode(own)

    return _coded_twice(df, vocabulary, text, pa.string(), "string", (ids, decoded), spelt)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Every row with the text that its ids spell in a new column ``text``; null ids spell ''.

    Bytes that are not UTF-8 become the replacement character.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(packed):
        tool = codec(shared.value)
        return common.strings([tool.decode(x) for x in common.arrays_of(packed)])

    return common.append_column(df, run, F.col(f"`{ids}`"), text, "string", as_list=False)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    import public_tokenizers

    vocabulary = read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_and_decode(documents, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
