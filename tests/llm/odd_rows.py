"""Rows that operators must bear."""

#: Nulls in every column, empty and blank texts, one letter, signs only, repeated rows, a very long text.
ODD = [
    (None, None, None, None),
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \n\t ", None, "a"),
    (4, "a", "en", "a"),
    (5, "!!! 123 ###", "en", "a"),
    (6, "the same words stand here twice over", "en", "a"),
    (6, "the same words stand here twice over", "en", "a"),
    (None, "the same words stand here twice over", "fr", "b"),
    (7, "word " * 60_000, "en", "b"),
    (8, "é à ü 漢字 \U0001f600 text", "fr", "b"),
]
