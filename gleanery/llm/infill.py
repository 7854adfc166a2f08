"""Fill-in-middle: texts cut in three at units and put together again in another order.

A unit is a run of ASCII letters or any other single code point. A text lies in blocks of a
fixed number of code points, and a Fenwick tree over the blocks holds how many units begin and
how many code points lie in each range of them. A cut behind the first k units is found by
binary lifting down the tree to the block where unit k begins, then by one look at that block
alone. Building passes over the text a stretch of blocks at a time, so beside the text and the
tree no more than a stretch is held.

Which texts are cut, where, and in which order follows from a hash of the seed and the id, so a
repeated task makes the same rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points of a block, and blocks that are counted together.
BLOCK, STRETCH = 512, 128
MADE = "struct<form:string,output:string,units:bigint,prefix_chars:bigint,middle_chars:bigint>"


def _starts(text: str, inside: bool) -> np.ndarray:
    """For each code point whether a unit begins there; ``inside``: a letter precedes the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    # lower case by one bit; no other code point becomes a letter by it
    letter = ((points | 32) - 97) < 26
    follows = np.empty_like(letter)
    follows[:1] = inside
    follows[1:] = letter[:-1]
    return ~(letter & follows)


def _is_letter(character: str) -> bool:
    return character.isascii() and character.isalpha()


class UnitTree:
    """The units and code points of a text by block, in a Fenwick tree."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text, self.block = text, block
        units = [np.zeros(0, np.int64)]
        for start in range(0, len(text), block * STRETCH):
            part = text[start : start + block * STRETCH]
            begins = _starts(part, start > 0 and _is_letter(text[start - 1]))
            units.append(np.add.reduceat(begins, np.arange(0, len(part), block), dtype=np.int64))
        counts = np.concatenate(units)
        chars = np.full(len(counts), block, np.int64)
        if len(chars):
            chars[-1] = len(text) - block * (len(chars) - 1)
        self.units, self.chars = (self._tree(c) for c in (counts, chars))
        self.n_units = int(counts.sum())

    @staticmethod
    def _tree(counts: np.ndarray) -> list[int]:
        """Node i, from 1, holds the sum of the counts in (i - its lowest bit, i]."""
        until = np.concatenate([[0], np.cumsum(counts)])
        node = np.arange(len(until))
        return (until - until[node - (node & -node)]).tolist()

    def cut(self, units: int) -> int:
        """How many code points the first ``units`` units have."""
        if units >= self.n_units:
            return len(self.text)
        place, left, chars = 0, units, 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step := step >> 1:
            if place + step < len(self.units) and self.units[place + step] <= left:
                place += step
                left -= self.units[place]
                chars += self.chars[place]
        # unit ``units`` begins in the block after the first ``place``, behind ``left`` others
        inside = chars > 0 and _is_letter(self.text[chars - 1])
        begins = _starts(self.text[chars : chars + self.block], inside)
        return chars + int(np.flatnonzero(begins)[left])


@dataclass(frozen=True)
class Rates:
    """Per cent of texts that stay as they are, counted from the top, and of cut ones with the suffix first."""

    plain: int = 10
    suffix_first: int = 20


def transformed(text: str, id: int | None, seed: int, rates: Rates) -> tuple[str, str, int, int | None, int | None]:
    """Form, output, units, and the code points of prefix and middle."""
    tree = UnitTree(text)
    digest = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    one, two, kept, order = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or kept % 100 >= 100 - rates.plain:
        return "plain", text, tree.n_units, None, None
    first, second = (tree.cut(k) for k in sorted(h % (tree.n_units + 1) for h in (one, two)))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if order % 100 < rates.suffix_first:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return form, output, tree.n_units, first, second - first


def fill_in_middle(
    df: DataFrame,
    *,
    text: str = "text",
    id: str = "doc_id",
    made: str = "infill",
    seed: int = 1,
    rates: Rates = Rates(),
) -> DataFrame:
    """Every row of ``df`` with a struct ``made``, see ``MADE``.

    ``form`` is psm, spm or plain. Plain texts are put out as they are: empty ones, those that
    hold a marker, and the share in ``rates``; their lengths are null. A null text counts as
    empty, a null id as no digits behind the seed. Rows with the same id and text get the same
    result. Other columns pass through, one already named ``made`` is replaced.
    """

    def run(given: pa.Array) -> pa.Array:
        texts, ids = given.field("text").to_pylist(), given.field("id").to_pylist()
        rows = [transformed(t, i, seed, rates) for t, i in zip(texts, ids)]
        form, output, units, prefix, middle = zip(*rows) if rows else [()] * 5
        return pa.StructArray.from_arrays(
            [common.strings(form), common.strings(output), *(common.longs(x) for x in (units, prefix, middle))],
            ["form", "output", "units", "prefix_chars", "middle_chars"],
        )

    source = F.struct(common.whole(f"`{text}`").alias("text"), F.col(f"`{id}`").cast("long").alias("id"))
    return common.append_column(df, run, source, made, MADE, as_list=False)


def restored(output: Column, form: Column) -> Column:
    """The exact text that an output of a form was made from.

    The text of a cut output holds no marker, and none comes about where it meets one, so the
    first place of each marker is the one that was written.
    """
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    psm = F.split(body, f"{SUFFIX}|{MIDDLE}", 3)
    spm = F.split(body, f"{PREFIX}|{MIDDLE}", 3)
    return (
        F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and restored, as digests."""
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_in_middle(documents).select("doc_id", "infill.*")
    return made.select(
        "doc_id",
        F.col("units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


INFILL_SQL = """
WITH given AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents
), cut AS (
    SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
        CAST('0x' || digest[1:8] AS BIGINT) AS h1, CAST('0x' || digest[9:16] AS BIGINT) AS h2,
        CAST('0x' || digest[17:24] AS BIGINT) AS h3, CAST('0x' || digest[25:32] AS BIGINT) AS h4
    FROM given
), placed AS (
    SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS one,
        greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS two,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
            THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), parts AS (
    SELECT *, coalesce(array_to_string(units[1:one], ''), '') AS prefix,
        coalesce(array_to_string(units[one + 1:two], ''), '') AS middle,
        coalesce(array_to_string(units[two + 1:], ''), '') AS suffix
    FROM placed
)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""
