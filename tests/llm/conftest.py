import random

import pytest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(text):
    return (text or "").translate(LOW)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(["the", "of", "Straße", "été", "x", "lamp", "river,", "stone.", "día", "Run"]) + r.choice(["", "s", "\n", "!"]) for _ in range(n))


def odd_rows():
    """Nulls, empty and very long texts, repeats, copies, near copies, marks of templates and tokenizers."""
    long = prose(1, 30_000)
    near = prose(2, 120)
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two three four"), (6, "ONE two three FOUR"), (7, long), (8, long.upper().lower()),
        (9, near), (10, near + " extra"), (11, near.replace("lamp", "LAMP")), (12, prose(3, 400)), (12, prose(3, 400)), (13, "a<|endoftext|>b <|EndOfText|> <|im_end|>"),
        (14, "nbsp here é é ΑΣ İ 12345 it's we're 'sx 'Ss"), (15, "x" * 5000), (None, "no id here at all"), (16, "\\ <| \\\\<| � \x00 \U0001f600"),
        (17, "one two three four"), (18, "# # $ % & | < > *\n\n# # $ % & | < > *\n"),
    ]
    return [(i, t, "clash", 7, -1.5, "y") for i, t in rows]


SCHEMA = "doc_id long, text string, h string, n int, score double, part string"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
