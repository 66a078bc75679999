"""A small table of hard cases: nulls, empty and long texts, ties, repeated
rows, shared passages, and extra columns whose names operators use inside."""

import random
import re

from pyspark.sql import functions as F

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, src long, blob string, "
          "size string, bucket long, fp long, length long, count long, p double, root long, best_id long")


def words_of(text, lower=False):
    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def hard_texts(seed=3):
    rng = random.Random(seed)
    stock = ["lorem", "ipsum", "Dolor", "sit", "amet,", "consec", "tetur", "été", "naïve", "Über", "x", "42", "e.g.", "日本"]

    def prose(n):
        return "".join(rng.choice(stock) + rng.choice([" ", " ", " ", "  ", "\n", " \t", ". "]) for _ in range(n))

    passage = prose(70)
    base = [prose(rng.choice([1, 3, 9, 40, 120])) for _ in range(25)]
    near = base[3] + "tail"
    texts = [None, "", " \n\t", "x", "日", "A", *base, base[3], base[3], near, base[5].upper(),
             prose(15) + passage + prose(9), passage + prose(3), prose(4) + passage, passage,
             "same line\n" * 30, "a b c d e f g h " * 8, "word" * 4000, prose(6000),
             " odd\x1cspaces here", "tie", "tie", "|#$%&*<> " * 9]
    return texts


def documents_frame(spark, partitions=3):
    rng = random.Random(8)
    rows = []
    for i, t in enumerate(hard_texts()):
        rows.append((i * 3 + 1, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "Z", None, "é"]),
                     len(t or ""), -1, -2, "b", "s", 7, 8, 9, 10, 0.5, 11, 12))
    rows.append(rows[10])                       # a repeated row
    rows.append((None, "text without an id", None, None, 18, None, None, None, None, None, None, None, None, None, None, None))
    rows.append((4, "another text with the id of one before", "en", "a", 38, 0, 0, "", "", 0, 0, 0, 0, 0.0, 0, 0))
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions, F.col("n_chars"))
