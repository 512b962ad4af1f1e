"""Texts and tables that the tests of the text operators share."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size string, component string"

WORDS = "the of and to in is that for it as was with stone river garden window letter morning winter".split()


def prose(seed, words=60):
    rng = random.Random(seed)
    text = [rng.choice(WORDS) + ("" if rng.random() < 0.7 else str(rng.randrange(999))) for _ in range(words)]
    return " ".join(text)


def awkward():
    """Null and blank fields, very short and long texts, copies, repeated rows and ids, clashing extra columns."""
    rows = [(k, prose(k), "en", f"s{k % 3}", 1, "x", "y") for k in range(1, 31)]
    rows += [(100 + k, prose(k), "en", None, None, None, None) for k in range(1, 6)]
    rows += [rows[0], rows[0]]
    rows += [
        (200, None, "en", "s1", 0, "x", "y"),
        (201, "", None, "s1", 0, "x", "y"),
        (202, " \t\n\x0b\x0c\r ", "en", "s2", 0, "x", "y"),
        (203, "one", None, None, 0, "x", "y"),
        (204, " 　 \x1c a b", "de", "", 0, "x", "y"),
        (205, prose(77, 30_000), "en", "s0", 0, "x", "y"),
        (None, prose(1), "en", "s0", 0, "x", "y"),
        (None, None, None, None, None, None, None),
        (206, "ÄÖ\U0001d54f | *** ### ... 😀 #$%&|<>*", "de", "null", 0, "x", "y"),
        (207, "x" * 5000, "fr", "s1", 0, "x", "y"),
    ]
    return rows
