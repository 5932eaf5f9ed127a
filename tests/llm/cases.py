"""Small documents with the awkward cases: nulls, empty and long texts, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

KIND = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()),
    # names that operators use inside
    ("sha", T.StringType()), ("kept", T.BooleanType()), ("node", T.LongType()), ("rep", T.LongType()), ("n", T.LongType()),
    ("digest", T.StringType()), ("chunk", T.LongType()), ("row", T.LongType()), ("_gone", T.LongType()), ("key", T.StringType()))])
VOCAB = [a + b for a in "ba de fi go lu mi no pa re so tu va zé".split() for b in ("n", "st", "rra", "x", "l")]


def prose(draw: random.Random, n: int) -> str:
    return " ".join(draw.choice(VOCAB) for _ in range(n))


def edited(draw: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        words[draw.randrange(len(words))] = draw.choice(VOCAB) + str(draw.randrange(99))
    return " ".join(words)


def texts(seed: int = 1) -> list:
    """Originals, exact and near copies around one hot text, shared passages, odd white space, nulls."""
    draw = random.Random(seed)
    base, passage = prose(draw, 120), prose(draw, 30)
    out = [prose(draw, draw.randrange(1, 200)) for _ in range(60)]
    out += [base] * 40 + [base.upper()] * 3 + [edited(draw, base, draw.randrange(1, 14)) for _ in range(60)]
    out += [prose(draw, 20) + " " + passage + " " + prose(draw, 20) for _ in range(25)]
    out += [None, None, "", "", " ", "\n\t", "one", "one two", "one two", "ONE two three", prose(draw, 6000),
            "tab\tand\x0bodd\x0cspace  twice", "é " * 30, "x" * 5000, "\u00a0no\u2003break\u00a0", "a\x1cb c"]
    draw.shuffle(out)
    return out


def documents(spark, values=None, repeat_rows: bool = True):
    values = texts() if values is None else values
    rows = [(i * 3 + 1, t, "en", "hot" if i % 3 else f"s{i % 7}", None if t is None else len(t),
             "clash", True, 5, 6, 7, "d", 8, 9, 10, "k") for i, t in enumerate(values)]
    rows += rows[:5] if repeat_rows else []
    return spark.createDataFrame(rows, KIND)


def empty(spark):
    return spark.createDataFrame([], KIND)
