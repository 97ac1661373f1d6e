"""Awkward tables that every operator must take: nulls, empty and long texts, ties,
repeated rows, further columns whose names operators use themselves."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, size string, key string, score string, "
          "bucket string, n string, h string, place string, part string, band string, predicted string, "
          "Label string, row string, target string")
CLASHES = len(SCHEMA.split(", ")) - 4


def sentence(rng, n):
    vowels, rest = "aeiou", "bcdfgklmnprst"
    return " ".join("".join(rng.choice(rest) + rng.choice(vowels) for _ in range(rng.randint(1, 4))) for _ in range(n))


def texts(seed=1):
    rng = random.Random(seed)
    base = [sentence(rng, 120) for _ in range(6)]
    shared = sentence(rng, 40)
    out = list(base)
    out += [base[0], base[0], base[1]]  # copies
    words = base[2].split()
    words[60] = "changed"
    out.append(" ".join(words))  # near copy
    out += [f"{sentence(rng, 30)}\n{shared}\n{sentence(rng, 30)}" for _ in range(4)]
    out += ["", None, "   \n\t ", "a", "one two", "ab cd ef gh ij", "x" * 49, "y" * 50, "y" * 51]
    out += ["the the the the " * 40, "é à ü ñ " * 30, "tabs\tand\x0bfeeds\x0c \r\n lines\n\n\nlines",
            "<|endoftext|> is text", "  odd \x1c spaces   here"]
    out.append(" ".join(sentence(rng, 50) for _ in range(1200)))  # some 300,000 characters
    return out


def documents(spark, with_null_ids=True):
    rng = random.Random(7)
    rows = [(i, t, "en", rng.choice(["a", "b", "c", None])) for i, t in enumerate(texts())]
    rows += [rows[3], rows[3]]  # repeated rows
    rows.append((5, "another text of an id that is there already", "en", "b"))
    if with_null_ids:
        rows += [(None, texts()[4], "en", "a"), (None, None, None, None)]
    return spark.createDataFrame([r + ("clash",) * CLASHES for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=((0, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, 0), (25, 0, 0), (25, 0, 0), (None, 1, 0), (4, None, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
