"""Awkward documents, and rows in a fixed order."""

LONG = "the quick brown fox jumps over the lazy dog and runs away from it " * 1500
ROWS = [
    (1, "the cat sat on the mat\n and  slept", "en"),
    (2, "the cat sat on the mat and slept", "en"),
    (3, None, "en"),
    (4, "", None),
    (5, " \t\n ", "fr"),
    (6, LONG, "en"),
    (7, LONG + "x", "en"),
    (8, "le chat dort sur le tapis et il rêve", "fr"),
    (8, "le chat dort sur le tapis et il rêve", "fr"),
    (9, "中文字符 🙂 1234", None),
    (None, "the cat sat on the mat and slept", "en"),
    (None, None, None),
    (12, "one", "en"),
    (13, "The CAT sat on the mat AND slept", "en"),
    (14, LONG, "en"),
]
#: Columns that operators use inside, under the same names.
CLASHES = "id name row_no key block pieces component_id kept score shard slot size print cell tokens chunk x length".split()


def by(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
