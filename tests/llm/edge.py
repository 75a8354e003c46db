"""Hard small tables: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string, id string, text_hash string, _lw_key int"


def words(text):
    return WORDS.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def long_text(n=20_000, seed=3):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéßñ") for _ in range(r.randint(1, 9))) for _ in range(3_000)]
    return " ".join(r.choice(vocabulary) + r.choice(["", "", "", ",", ".\n"]) for _ in range(n))


def rows():
    texts = [(1, None, "a"), (2, "", "a"), (3, "The cat sat on the mat\nThe cat sat on the mat", None), (4, " \t\n\x0b ", "b"),
             (3, "The cat sat on the mat\nThe cat sat on the mat", None), (None, "x y z", "b"), (6, long_text(), "c"),
             (7, "İx ﬁ <|endoftext|> \\ [INST] a\x1cb Σας #### |", "c"), (8, "the CAT sat ON the mat", "ü"), (9, "x y z", None),
             (10, long_text(), "c"), (11, "w " * 200, "a")]
    return [(i, t, "en", s, 5, None, "size", "id", "h", 1) for i, t, s in texts]


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
