"""Rows that every operator must take: nulls, empty and blank texts, repeats, clashing names, long texts."""

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _row string, key string, fp long, low long, number int"
EXTRA = (None, "x", 7, 8, 9)


def rows(texts):
    return [(i, t, "en", "s", None, *EXTRA) for i, t in enumerate(texts)]


LONG = " ".join(f"w{i % 3000} some words" for i in range(40_000))
ODD = [
    (1, None, None, None, None, *EXTRA),
    (2, "", "en", "s", 0, *EXTRA),
    (3, " \n\t ", "en", None, 4, *EXTRA),
    (4, "one", None, "s", 3, *EXTRA),
    (5, "the same text twice " * 20, "en", "s", None, *EXTRA),
    (5, "the same text twice " * 20, "en", "s", None, *EXTRA),
    (6, "the same text twice " * 20, "en", "t", None, *EXTRA),
    (None, "no id here", "en", "s", None, *EXTRA),
    (None, None, None, None, None, *EXTRA),
    (7, LONG, "en", "t", None, *EXTRA),
    (8, "nul \x00 and \x1c odd \x85 space　 😀 ẞÉ", "de", "t", None, *EXTRA),
]
