"""Chat formatting by Spark expressions only.

The turns of a conversation are collected as structs and sorted. Adjacent turns of one role are
merged to a run by slicing the sorted array at the places where the role changes, so the cost
is linear in the turns. A run is one marked block, its turns set apart by ``NEXT``:

    system      [SYS]text[/SYS]
    user        [INST]text[NEXT]text[/INST]
    assistant   <s>text</s>
    other       [ROLE]name[SAYS]text[/ROLE]

Texts and names are escaped before they are collected: a backslash follows the first letter of
whatever would read as a marker, or as an escaped one, and one backslash less is read back. So
no marker stands in an escaped text, and none comes about where a text meets a marker: markers
begin with ``<`` or ``[`` and hold neither behind that, and end with ``>`` or ``]``.

The loss mask is written in lengths: what stands before, between and behind markers takes turns
with the markers, and those pieces that are an assistant's texts count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common

NEXT, SAYS = "[NEXT]", "[SAYS]"
#: By role: what opens and closes its block. Roles beside these are written out.
BLOCKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]")
LEARNED = "assistant"
#: A marker without its first letter, as a pattern.
_TAIL = r"(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|SAYS\]|NEXT\])"
MARKER = rf"[<\[]{_TAIL}"
_RUN = r"(?s)<s>.*?</s>|\[INST\].*?\[/INST\]|\[SYS\].*?\[/SYS\]|\[ROLE\].*?\[/ROLE\]"
MASK = "array<struct<chars:int,loss:boolean>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){_TAIL}", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){_TAIL}", "$1$2$3")


def _by_role(role: Column, values: dict[str, Column], other: Column) -> Column:
    chain = F.when(F.lit(False), other)
    for name, value in values.items():
        chain = chain.when(role == name, value)
    return chain.otherwise(other)


def _opening(role: Column) -> Column:
    return _by_role(role, {r: F.lit(o) for r, (o, _) in BLOCKS.items()}, F.lit(OTHER[0]))


def _closing(role: Column) -> Column:
    return _by_role(role, {r: F.lit(c) for r, (_, c) in BLOCKS.items()}, F.lit(OTHER[1]))


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(F.length(text).alias("chars"), loss.alias("loss"))


def _written(run: Column) -> Column:
    """The text of one run."""
    named = _by_role(run.role, {r: F.lit("") for r in BLOCKS}, F.concat(run.called, F.lit(SAYS)))
    return F.concat(_opening(run.role), named, F.array_join(run.texts, NEXT), _closing(run.role))


def _masked(run: Column) -> Column:
    """What precedes a run and what is in it, in lengths; a marker and a piece take turns."""
    no, between = F.lit(False), F.struct(F.lit(len(NEXT)).alias("chars"), F.lit(False).alias("loss"))
    before = F.struct(F.lit(0).alias("chars"), no.alias("loss"))
    named = _by_role(
        run.role,
        {r: F.array().cast(MASK) for r in BLOCKS},
        F.array(_piece(run.called, no), _piece(F.lit(SAYS), no)),
    )
    texts = F.transform(
        run.texts,
        lambda t, i: F.when(i == 0, F.array(_piece(t, run.role == LEARNED))).otherwise(
            F.array(between, _piece(t, run.role == LEARNED))
        ),
    )
    return F.concat(
        F.array(before, _piece(_opening(run.role), no)), named, F.flatten(texts), F.array(_piece(_closing(run.role), no))
    )


def format_turns(
    turns: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conversation, formatted, mask)``: one row for each conversation.

    Turns go by ``turn``, nulls first, ties by role and escaped text; repeated rows are repeated turns.
    A null text or role counts as empty. Rows of a null conversation are one conversation of its
    own. Other columns are left out, whatever their names. A conversation is one value of the
    result, so all its turns meet in one task; texts are escaped before that.
    """
    own = turns.select(
        F.col(f"`{conversation}`").alias("of"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        escaped(common.whole(f"`{text}`")).alias("text"),
    )
    turn_struct = F.struct("turn", "role", "text")
    collected = own.groupBy("of").agg(F.array_sort(F.collect_list(turn_struct)).alias("t"))

    def role_at(place: Column) -> Column:
        return F.element_at("t", place).role

    heads = F.filter(F.sequence(F.lit(1), F.size("t")), lambda i: (i == 1) | (role_at(i) != role_at(i - 1)))

    def run(head: Column, i: Column) -> Column:
        own = F.slice("t", head, F.coalesce(F.try_element_at("heads", i + 2), F.size("t") + 1) - head)
        texts = F.transform(own, lambda x: x.text)
        return F.struct(role_at(head).alias("role"), escaped(role_at(head)).alias("called"), texts.alias("texts"))

    runs = collected.withColumn("heads", heads).select("of", F.transform("heads", run).alias("runs"))
    end = F.array(F.struct(F.lit(0).alias("chars"), F.lit(False).alias("loss")))
    return runs.select(
        F.col("of").alias(conversation),
        F.array_join(F.transform("runs", _written), "").alias("formatted"),
        F.concat(F.flatten(F.transform("runs", _masked)), end).cast(MASK).alias("mask"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns ``array<struct<role,text>>`` of a formatted conversation, unescaped."""

    def block(run: Column) -> Column:
        role, body = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name, (opening, closing) in [*BLOCKS.items(), (None, OTHER)]:
            here = F.startswith(run, F.lit(opening))
            inside = F.substr(run, F.lit(len(opening) + 1), F.length(run) - len(opening) - len(closing))
            if name is None:
                name_and_texts = F.split(inside, r"\[SAYS\]", 2)
                role = F.coalesce(role, unescaped(name_and_texts[0]))
                body = F.coalesce(body, name_and_texts[1])
            else:
                role = F.coalesce(role, F.when(here, F.lit(name)))
                body = F.coalesce(body, F.when(here, inside))
        return F.struct(role.alias("role"), F.split(body, r"\[NEXT\]", -1).alias("texts"))

    runs = F.transform(F.regexp_extract_all(formatted, F.lit(_RUN), F.lit(0)), block)
    return F.flatten(
        F.transform(
            runs,
            lambda run: F.transform(run.texts, lambda t: F.struct(run.role.alias("role"), unescaped(t).alias("text"))),
        )
    )


def under_mask(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order.

    Pieces between markers are cut once and held against the lengths of the mask; a mask that
    does not fit its text is an error.
    """
    pieces = F.split(formatted, MARKER, -1)
    lengths = F.filter(mask, lambda m, i: i % 2 == 0)
    fits = F.transform(pieces, lambda p: F.length(p)) == F.transform(lengths, lambda m: m.chars)
    taken = F.filter(F.arrays_zip(pieces.alias("piece"), lengths.alias("m")), lambda p: p.m.loss)
    texts = F.transform(taken, lambda p: unescaped(p.piece))
    return F.when(fits, texts).otherwise(F.raise_error(F.lit("the loss mask does not fit its text")))


#: The conversation that the contract adds.
ADDED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and the added one, formatted and read back."""
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED, "conv_id long, turn long, role string, text string")
    made = format_turns(given.unionByName(added))
    read = made.select(
        "conv_id",
        turns_of(F.col("formatted")).alias("turns"),
        F.array_join(under_mask(F.col("formatted"), F.col("mask")), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    spoken = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|SAYS\]|NEXT\])', '\1\\\2\3', 'g') AS e_text,
        regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|SAYS\]|NEXT\])', '\1\\\2\3', 'g') AS e_role
    FROM turns
), placed AS (
    SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before
    FROM marked WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, e_text)
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(e_text) + CASE
        WHEN before = role THEN 6
        WHEN role = 'system' THEN 11
        WHEN role = 'user' THEN 13
        WHEN role = 'assistant' THEN 7
        ELSE 19 + length(e_role) END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
