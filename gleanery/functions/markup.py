"""Visible text of a captured page, as Column functions.

Java's regex engine recurses on repeated groups unless they are possessive, so every
repeated group below is; a page of any length then needs constant stack.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import collapse_space

# --- fixed values: elements whose text is never shown --------------------------------
RAW_TEXT_ELEMENTS = ["script", "style"]
HIDDEN_ELEMENTS = ["noscript", "header", "footer", "nav", "template", "rt", "rp"]
VOID_ELEMENTS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                 "param", "source", "track", "wbr"]
# --- end of fixed values ------------------------------------------------------------

# Every pattern starts with one literal character, which lets the engine skip to it.
# Attributes of an opening tag that does not close itself.
_OPEN = r"(?:\s(?:[^>]*[^>/])?)?>"
_HIDDEN = "|".join(HIDDEN_ELEMENTS)
_COMMENT = r"!--.*?(?:-->|\z)"


def _subtrees(names: list[str]) -> str:
    """Elements from their opening tag to the next closing one, or to the end."""
    return "|".join(rf"{n}{_OPEN}.*?(?:</{n}\s*>|\z)" for n in names)


_NO_TEXT = rf"(?is)<(?:{_COMMENT}|{_subtrees(RAW_TEXT_ELEMENTS)})"
# A quote opens a value only after an equals sign; elsewhere it is a character like others.
_VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_ANY_TAG = rf"/?[a-z](?:[^>=]++|{_VALUE})*+(?:>|\z)|[!?][^>]*(?:>|\z)"
_TAG = rf"(?is)<(?:{_ANY_TAG})"
# All that is not text on a page whose hidden elements are even.
_FLAT = rf"(?is)<(?:{_COMMENT}|{_subtrees(RAW_TEXT_ELEMENTS + HIDDEN_ELEMENTS)}|{_ANY_TAG})"
_TAG_NAME = r"^<(/?[a-zA-Z][^\s/>]*)"
_EMPTY_TAG = r"/\s*>$"

# Entities that make up nearly all of a page's references; "amp" must come last.
_COMMON_ENTITIES = ["lt", "gt", "quot", "nbsp", "middot", "copy", "amp"]
_OTHER_ENTITY = (
    rf"&(?!(?:{'|'.join(_COMMON_ENTITIES)});)"
    "(?:#[0-9]|#[xX][0-9A-Fa-f]|[A-Za-z][A-Za-z0-9]*;)"
)
# What a page is looked over for at once: tags of hidden elements and rare references.
_MARK = (
    rf"[<&](?:(?is:(?<=<)(?:(?:{_HIDDEN})(?={_OPEN})|/(?:{_HIDDEN})(?=\s*>)))"
    rf"|(?<=&){_OTHER_ENTITY[1:]})"
)
# Among the marks, each ended by ">": an opening tag whose kind opens once more, or never closes.
_UNEVEN = rf"(?i)<({_HIDDEN})>(?!(?:(?!</?\1>)[^>]*+>)*+</\1>)"
_ENTITY_HEAD = r"^(#[xX][0-9A-Fa-f]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*(?=;));?"


def _code_point(number: Column) -> Column:
    """The character with this Unicode number, null outside the valid range."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    encoded = F.unhex(F.lpad(F.hex(F.when(valid, number)), 8, "0"))
    return F.decode(encoded, "UTF-32")


def _entity_piece(piece: Column) -> Column:
    """Decode the reference a piece starts with; the piece had followed an ampersand."""
    head = F.regexp_extract(piece, _ENTITY_HEAD, 0)
    name = F.regexp_extract(piece, _ENTITY_HEAD, 1)
    pairs = {"apos": ord("'"), **name2codepoint}.items()
    listed = "\x01".join(f"{entity}\x02{chr(point)}" for entity, point in pairs)
    named = F.str_to_map(F.lit(listed), F.lit("\x01"), F.lit("\x02"))
    # leading zeros say nothing; what is too long without them is no character
    digits = F.regexp_replace(name, "^#[xX]?0*", "")
    short = F.when(F.length(digits) <= 8, digits)
    hexadecimal = F.conv(short, 16, 10).try_cast("bigint")
    decimal = short.try_cast("bigint")
    character = (
        F.when(F.rlike(name, F.lit("^#[xX]")), _code_point(hexadecimal))
        .when(F.startswith(name, F.lit("#")), _code_point(decimal))
        .otherwise(F.try_element_at(named, name))
    )
    rest = F.substring(piece, F.length(head) + 1, F.length(piece))
    return F.coalesce(
        F.when(name != "", F.concat(character, rest)), F.concat(F.lit("&"), piece)
    )


def _decode_any(text: Column) -> Column:
    """Replace every character reference, piece by piece between ampersands."""
    return F.array_join(
        F.transform(
            F.split(text, "&"),
            lambda piece, i: F.when(i == 0, piece).otherwise(_entity_piece(piece)),
        ),
        "",
    )


def _decode_common(text: Column) -> Column:
    """Replace the common references of a text that has no others."""
    for name in _COMMON_ENTITIES:
        text = F.replace(text, F.lit(f"&{name};"), F.lit(chr(name2codepoint[name])))
    return text


def decode_entities(text: Column, has_rare: Column | None = None) -> Column:
    """Replace character references; unknown and unterminated names stay as they are."""
    rare = F.rlike(text, F.lit(_OTHER_ENTITY)) if has_rare is None else has_rare
    return F.when(rare, _decode_any(text)).otherwise(_decode_common(text))


def _shown_parts(html: Column) -> Column:
    """Text outside hidden elements, which close as in a tree: with their parent at the latest.

    One walk over the page's tags with a stack of open elements. It keeps where hidden
    elements begin and end, as numbers of tags, and never copies text.
    """
    bare = F.regexp_replace(html, _NO_TEXT, " ")
    tags = F.regexp_extract_all(bare, F.lit(f"({_TAG})"), F.lit(1))
    void = F.array(*[F.lit(n) for n in VOID_ELEMENTS])
    hidden = F.array(*[F.lit(n) for n in HIDDEN_ELEMENTS])

    def opens(tag, i):
        name = F.lower(F.regexp_extract(tag, _TAG_NAME, 1))
        empty = F.rlike(tag, F.lit(_EMPTY_TAG)) | F.array_contains(void, name)
        return F.struct(F.when(~empty, name).otherwise("").alias("name"), i.alias("at"))

    def state(open_, depth, after, shown):
        return F.struct(
            open_.alias("open"), depth.alias("depth"), after.alias("after"), shown.alias("shown")
        )

    def upto(after, last, shown):
        """``shown`` with the parts from ``after`` to ``last``, counted from 0."""
        some = F.struct((after + 1).alias("first"), (last - after + 1).alias("parts"))
        return F.array_append(shown, some)

    # depth: where the element that hides the rest lies on the stack, 0 if none does
    # after: the first part that is not yet known to be shown; part i precedes tag i
    start = state(
        F.array().cast("array<string>"),
        F.lit(0),
        F.lit(0),
        F.array().cast("array<struct<first:int,parts:int>>"),
    )

    def step(acc, tag):
        open_, depth, after, shown = (acc[n] for n in ("open", "depth", "after", "shown"))
        name, at = tag["name"], tag["at"]
        closes = F.startswith(name, F.lit("/"))
        back = F.array_position(F.reverse(open_), F.substring(name, 2, 1_000_000))
        left = (F.size(open_) - back).cast("int")
        hides = (depth == 0) & F.array_contains(hidden, name)
        pushed = state(
            F.array_append(open_, name),
            F.when(hides, F.size(open_) + 1).otherwise(depth),
            after,
            F.when(hides, upto(after, at, shown)).otherwise(shown),
        )
        ends = (depth > 0) & (left < depth)
        popped = state(
            F.slice(open_, F.lit(1), left),
            F.when(ends, 0).otherwise(depth),
            F.when(ends, at + 1).otherwise(after),
            shown,
        )
        return F.when((name == "") | (closes & (back == 0)), acc).when(closes, popped).otherwise(pushed)

    parts = F.split(bare, _TAG)
    last = F.size(parts) - 1

    def ranges(acc):
        rest = upto(acc["after"], last, acc["shown"])
        return F.when(acc["depth"] == 0, rest).otherwise(acc["shown"])

    ranged = F.aggregate(F.transform(tags, opens), start, step, ranges)
    def joined(parts):
        pieces = F.transform(ranged, lambda r: F.array_join(F.slice(parts, r["first"], r["parts"]), " "))
        return F.array_join(pieces, " ")

    # an array of one, so that the page is split once and not for each range
    return F.element_at(F.transform(F.array(parts), joined), 1)


def visible_text(html: Column) -> Column:
    """Text outside hidden elements, tags and comments, whitespace collapsed.

    One look over the page as it came finds its marks, and both choices are made on those.
    Pages where a hidden element nests in its own kind or lacks its closing tag, and pages
    with rare entities, take a slower way.
    """
    found = F.regexp_extract_all(html, F.lit(_MARK), F.lit(0))
    marks = F.concat(F.array_join(found, ">"), F.lit(">"))

    def chosen(marks):
        flat = F.regexp_replace(html, _FLAT, " ")
        untagged = F.when(F.rlike(marks, F.lit(_UNEVEN)), _shown_parts(html)).otherwise(flat)
        text = decode_entities(untagged, F.contains(marks, F.lit("&")))
        return collapse_space(F.coalesce(text, F.lit("")))

    # an array of one, so that the marks are looked for once
    text = F.element_at(F.transform(F.array(marks), chosen), 1)
    # told first, so that no plan carries the look for sources that have no page
    return F.when(html.isNull(), F.lit("")).otherwise(text)
