"""Small tables with every awkward case, as plain rows."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, hash long, n string, key long, kept boolean, size string, _id long"
)
CLASH = (7, "n", None, True, "size", 1)


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def awkward_texts():
    """(doc_id, text): nulls, empty and blank texts, a very long one, ties, repeated rows, copies and near copies."""
    rng = random.Random(11)
    base = [words(rng, 60) for _ in range(6)]
    long = words(rng, 30_000)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, base[0]), (5, base[0].upper()), (5, base[0].upper()), (6, base[0]),
        (7, long), (8, long + " and one more"), (9, "x" * 30_000), (10, "é" * 3000 + " <|endoftext|> \x1c ß ẞ İ don't 12,5.. a.b"),
        (11, "word"), (12, "two words"), (13, base[1] + "\n" + base[2]), (14, base[1][:-4] + "\n" + base[3]),
        (15, base[2] + " " + base[2]), (16, "ab" * 400), (17, "ab" * 400), (18, "Σ　σς ñandú x"),
    ]
    for i in range(20, 60):
        parts = base[4].split()
        for _ in range(rng.randint(0, 3)):
            parts[rng.randrange(len(parts))] = words(rng, 1)
        rows.append((i, " ".join(parts)))
    return rows + [(-3, base[5]), (1 << 40, base[5] + " tail")]


def as_rows(texts):
    sources = ["s1", "s2", None, "s3", ""]
    return [(i, t, "en", sources[k % 5], 3, *CLASH) for k, (i, t) in enumerate(texts)]
