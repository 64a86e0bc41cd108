"""Small tables with all that is odd: nulls, empty and long texts, ties, copies, clashing names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; a table may have them too.
CLASHES = ("fp", "place", "rules", "band", "language", "slot", "document", "gone", "line_no", "hi", "lo", "spans", "body")


def prose(number: int, words: int) -> str:
    """Made-up words that no other number has."""
    out = []
    state = number * 7919 + 17
    for _ in range(words):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append("".join(chr(97 + (state >> s) % 26) for s in (20, 28, 36, 44, 52)[: 2 + (state >> 60) % 4]))
    return " ".join(out)


def odd_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, copies and near copies."""
    long = "\n".join(prose(1000 + i, 40) for i in range(600))
    shared = prose(5, 70)
    rows = [
        (0, None, "en", "a"), (1, "", None, None), (2, " \n\t ", "en", "a"), (3, "one", "en", "a"),
        (4, "Two words", "xx", "b"), (5, "a b c d", "en", "a"), (None, prose(9, 90), "en", "a"), (None, None, None, None),
        (6, long, "en", "a"), (7, prose(1, 120), "en", "a"), (7, prose(1, 120), "en", "a"), (7, prose(2, 80), "en", "b"),
        (8, prose(1, 120), "de", "c"), (9, prose(1, 119) + " end", "de", "c"), (None, prose(1, 120), "en", "a"),
        (10, prose(3, 60) + "\n" + shared + "\n" + prose(4, 60), "en", "a"),
        (11, prose(6, 55) + "\n" + shared + "\n" + prose(7, 30), "en", "a"),
        (12, "É ô ß " * 30 + prose(8, 60), "fr", "a"), (13, "spam ham eggs " * 40, "en", "a"),
        (14, "aaaa" * 100, "en", "a"), (15, "x" * 5000, "en", "a"),
        (16, prose(3, 60) + "\n" + prose(11, 50) + "\n" + prose(3, 60), "en", "a"),
        (17, prose(12, 50).upper() + "!!\n" + prose(13, 30), "en", "a"),
        (18, "\n".join([prose(14, 12), prose(14, 11) + " " + prose(14, 12).split()[-1] + "x", prose(15, 12)] * 3), "en", "a"),
        (-5, prose(16, 30) + " #*$%&|<> " + prose(17, 40), "en", "a"),
    ]
    return [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in rows]
