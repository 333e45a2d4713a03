import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
sys.path.insert(0, os.path.dirname(os.path.dirname(HERE)))

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i * 7919 % 104729}" for i in range(30_000))

#: null and empty texts, blank ones, ties, repeated rows, one very long text
DOCS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, "one two  three"), (6, "one\ntwo three"),
    (7, LONG), (8, LONG + " more"), (9, "A b c d e f g h i j k l m n o p q r s t u v"),
    (10, "a B c d e f g h i j k l m n o p q r s t u v"), (11, "a b c d e f g h i j k l m n o p q r s t u x"),
    (None, "no id here at all"), (None, "one two three"),
    (12, "same line\nother 12"), (13, "Same LINE \nother 13"), (14, "<|endoftext|> x  y   z <|endoftext|>"),
    (15, "é à  ü　ß \x1c a\x85 b\r\n日本 語😀 😀"), (16, "x " * 5000),
]
REPEATED = DOCS + [(4, "one two three"), (4, "one two three"), (2, ""), (None, "no id here at all")]


def documents(spark, rows, clash=True):
    """A documents table; its other columns clash with names that operators use."""
    full = [(d, t, ["en", "de", None][i % 3], [None, "s1", "s2", ""][i % 4], -1, "x", 7, True, "z") for i, (d, t) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if clash:
        schema += ", id string, n long, kept boolean, k1 string"
    else:
        full = [r[:5] for r in full]
    return spark.createDataFrame(full, schema)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def got(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def want(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="session")
def tokenizer():
    from tokenizers import Tokenizer

    from twinrun.llm.tokenizer import tokenizer_path
    return Tokenizer.from_file(tokenizer_path())
