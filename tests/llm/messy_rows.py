"""Rows with everything that operators must take: nulls, blanks, repeats, a long text."""

from __future__ import annotations

LONG = "long words of a text that goes on and on\n" * 2000
MESSY = [
    (1, "You are an idiot, a worthless idiot. password=abcdef123456", "en", "a", 10, "x", 1.0),
    (1, "You are an idiot, a worthless idiot. password=abcdef123456", "en", "a", 10, "x", 1.0),
    (2, None, None, None, None, None, None),
    (3, "", "", "", 0, "", 0.0),
    (4, LONG, "en", "b", len(LONG), "y", 2.0),
    (5, "plain words here, nothing else to see in this one", "en", "b", 49, "z", 3.0),
    (6, "plain words here, nothing else to see in this one", "en", None, 49, "z", 3.0),
    (None, "no id at all but some words", "en", "a", 27, None, None),
    (None, None, None, None, None, None, None),
    (7, " \n\t ", "en", "c", 4, "ids", 4.0),
    (8, "één woord 人 <|endoftext|> it's 12.5%", "nl", "c", 35, "q", 5.0),
]
#: Columns that operators make too, to see what becomes of those given.
MESSY_COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, score double"
)
