"""Rows that every operator must take."""

#: null, empty, blank, short, repeated and very long texts, and a null id
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "one two three"),
       (7, "aé中\U0001f600 x" * 9000), (8, "x" * 30_000), (9, "\n\n"), (None, "one two three"), (10, "one two three"),
       (10, "one two three")]
