import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from hazegrid.llm import importance
from tests.llm.helpers import LONG, ODD, no_docs, odd_docs, syllable_texts

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, longest, buckets):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(docs, target, longest, buckets, percent, least, seed):
    """Rows (id, n_features, weight, score, rank) of (id, text) pairs."""
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in features(text, longest, buckets)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        words, f = features(text, longest, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    order = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(order[:percent * len(order) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("longest, percent", [(1, 10), (1, 100), (2, 37), (3, 0)])
def test_against_a_plain_loop(spark, longest, percent):
    texts = syllable_texts(400, 5)
    texts[7] = texts[8] = "Über-Größe 3D x_y ABC\tabc\x7fz " * 9
    docs = list(zip(range(400), texts))
    target = syllable_texts(30, 5, vocabulary=40)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    out = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), longest, 500, percent, 20, few=5, median_of=11)
    assert shown(out) == plain(docs, target, longest, 500, percent, 20, 2024)


def test_cutoff_is_every_key(spark):
    """Small medians, discarding sides and writing anew: the key of every place, with ties and nulls."""
    r = random.Random(3)
    rows = [(r.randint(0, 5), r.choice([None, 1, 2, 3]), i) for i in range(300)] + [(3, 2, 300 + i) for i in range(150)]
    order = sorted(rows, key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
    df = spark.createDataFrame(rows, "score long, id long, place long").repartition(5)
    for nth in (1, 2, 99, 200, 449, 450):
        assert tuple(importance.cutoff(df, nth, median_of=20, few=4).values()) == order[nth - 1]
    key = dict(zip(("score", "id", "place"), order[222]))
    assert df.where(importance.at_or_before(key)).count() == 223
    with pytest.raises(ValueError):
        importance.cutoff(df, 451)


def test_a_round_discards_a_quarter(spark):
    """Each pivot, the weighted median of medians, leaves at most three quarters of the keys on either side."""
    rows = [(int(i ** 1.5) % 997, i, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "score long, id long, place long").repartitionByRange(9, "score")
    reports = importance._medians(df, None, 50)
    assert sum(x["n"] for x in reports) == 2000
    reached = 0
    for x in sorted(reports, key=importance._key):
        reached += x["n"]
        if reached >= 1000:
            break
    before = df.where(importance.at_or_before(x.asDict())).count()
    assert 500 <= before <= 1501


def test_words_are_whole_texts():
    f = importance.Features(1, 10_000)
    assert f.of(LONG.encode())[0] == len(WORD.findall(LONG)) and f.of(None)[0] == 0 and f.of(b"--- \n")[0] == 0
    assert f.of("A1-ß_ç z".encode())[0] == 4


def test_awkward_rows(spark):
    target = spark.createDataFrame([("one tie fox",), (None,), ("",)], "text string")
    out = importance.resample(odd_docs(spark), target, buckets=100, percent=50, least_words=2)
    want = plain([(r[0], r[1]) for r in ODD], ["one tie fox", None, ""], 1, 100, 50, 2, 2024)
    assert shown(out) == want and out.where(F.col("rank").isNotNull()).count() == 4
    empty = spark.createDataFrame([], "text string")
    assert importance.resample(odd_docs(spark), empty, buckets=100).count() == len(ODD)
    assert importance.resample(no_docs(spark), target).collect() == []
