"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te", "so", "ne") for b in ("ra", "st", "lin", "vo", "em", "pa", "tu")]


def prose(rng: random.Random, n: int) -> str:
    out = [rng.choice(WORDS) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "\n", "  ", "\t", ". "]) for w in out)


def documents(seed: int = 1) -> list[tuple]:
    """``(doc_id, text, source)``: copies, near copies, shared passages, long, empty and null texts,
    null and repeated ids, repeated rows, one source with most rows."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    base = [prose(rng, rng.choice([3, 40, 150, 300])) for _ in range(30)]
    texts: list = list(base)
    texts += [base[i] for i in (1, 1, 2, 5, 5, 5)]
    texts += [base[3].replace(" ", "\n", 3), base[4] + " tail"]
    for i in (10, 11, 12, 13):
        words = base[i].split(" ")
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [prose(rng, 30) + passage + prose(rng, 25) for _ in range(8)]
    texts += ["lorem " * 90, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 4]
    texts += [prose(rng, 9000), "x" * 70_000, "", "", None, None, " \t\n ", "one", "zwölf Äpfel ñandú 東京 ẞ", "<|endoftext|> <|ENDOFTEXT|>a <|endof text|>"]
    rows = [(i, t, ["src0", "src1", "src2", None][0 if rng.random() < 0.6 else rng.randrange(4)]) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [(None, "no id here", "src1"), (None, None, None), rows[0], rows[0], (7, "another text with id seven", "src9")]
    return rows


SCHEMA = "doc_id long, text string, source string"
#: The same names as operators use inside, as extra columns.
CLASH = ("size", "row", "key", "batch", "fp", "component", "digest", "score", "length", "taken", "n", "p", "text_hash")


def table(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    return df
