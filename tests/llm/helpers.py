"""Frames with the awkward cases that every operator must take."""

import random

LONG = " ".join(f"w{i % 977}x{i // 7}" for i in range(60_000))

ODD = [  # doc_id, text, lang, source, n_chars, then columns whose names operators use themselves
    (1, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "a", 65),
    (1, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "a", 65),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (None, "a text without an id", "en", "b", 20),
    (None, None, None, None, None),
    (4, "12345 !!! ###", "xx", "b", 13),
    (5, LONG, "de", "a", len(LONG)),
    (6, "one", "fr", "a", 3),
    (7, "\n\n \t one\n\none\n", "fr", "", 14),
    (8, "tie tie tie tie", "fr", "a", 15),
    (9, "tie tie tie tie", "fr", "a", 15),
    (10, "The <|im_end|> ünïcödé 中文 text​ with  gaps", "zh", "b", 41),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["id", "row", "text_hash", "fp", "key", "block", "slot", "score", "kind", "part", "n", "held", "x"]


def odd_docs(spark, rows=ODD):
    df = spark.createDataFrame(rows, SCHEMA)
    for i, c in enumerate(CLASHES):
        df = df.selectExpr("*", f"'{c}{i}' AS `{c}`")
    return df


def no_docs(spark):
    return odd_docs(spark, [])


def syllable_texts(n, seed, words=(5, 60), vocabulary=300):
    r = random.Random(seed)
    lexicon = ["".join(r.choice("bdfgklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3))) for _ in range(vocabulary)]
    return [" ".join(r.choice(lexicon) for _ in range(r.randint(*words))) for _ in range(n)]
