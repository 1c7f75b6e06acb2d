"""Rows that every operator must give a defined result for."""

#: Nulls, empty and blank texts, ties, repeated rows, a long text.
HARD = [(1, "one two three four five six seven"), (2, None), (3, ""), (4, " \n\t "), (None, "no id"), (None, None),
        (2 ** 62 + 1, "a very large id"), (5, "one two three four five six seven"), (5, "one two three four five six seven"), (6, "word " * 30_000),
        (7, "é" * 200 + "\x00\x1c 日本 " + "x" * 5000), (8, "\n".join(["same line of words"] * 40))]
