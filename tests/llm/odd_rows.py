"""Small tables that hold what real ones may hold."""

import random

#: Names that operators use for their own columns.
CLASHING = ("block", "kept", "n_words", "rate", "score", "node", "text_sha256", "digest", "n_entities", "region")


def prose(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 7))) for _ in range(words))


PASSAGE = prose(7, 60)
ODD_ROWS = [
    (1, None), (2, ""), (3, " \n\t \n"), (4, "one two"), (4, "one two"), (None, "one two"), (None, None),
    (5, prose(1, 300)), (6, prose(1, 300)), (7, prose(1, 300) + " end"), (8, "x " + PASSAGE + " " + prose(2, 40)),
    (9, prose(3, 30) + "\n" + PASSAGE + "\t" + prose(4, 30)), (10, PASSAGE.upper()), (11, "word " * 200), (12, "é" * 300),
    (13, "ab" * 5000), (14, prose(5, 4000)), (15, prose(5, 2000) + " ñ " + prose(5, 2000)), (9, prose(6, 50)),
    (16, "Line\nline \n\n LINE\nother"), (17, "\x0bvertical\x0cfeed\r\nline"), (18, PASSAGE + " " + PASSAGE),
]


def lines_rows():
    common = "All rights reserved."
    return [(i, f"{common if i % 2 else common.upper() + ' '}\nown line {i}\n{common}\n") for i in range(14)] + ODD_ROWS


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
