import collections
import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hazegrid.llm import lm
from hazegrid.llm.common import fold
from tests.llm.helpers import SCHEMA, syllable_texts


def test_spelled_words_have_probabilities_that_add_up():
    words = [w.encode() for t in syllable_texts(30, 1) for w in t.split()]
    model = lm.Spelling.fresh()
    lm.spelling_counts(words, model.counts)
    model.learn(words)
    # The probabilities of all bytes that may begin a word, its end among them, add up to one but for unused codes
    buf, at = np.zeros(lm._PAD + 1, np.uint8), np.array([lm._PAD])
    whole = []
    for b in range(256):
        buf[lm._PAD] = b
        p = 1.0
        for k, _, node, bit, slots in lm._bits(buf, at, lm._contexts(buf, at)):
            one = model._chances(model.tables(), k, node, slots)[0]
            p *= one if bit[0] else 1 - one
        whole.append(p)
    assert abs(whole[32] - np.exp(model.cost([b""])[0])) < 1e-9 and 0.99 < sum(whole) <= 1 + 1e-9
    assert model.cost(words).mean() > lm.Spelling.fresh().cost(words).mean() / 2


def test_long_words_are_cut_into_pieces_without_a_difference(monkeypatch):
    words = [b"abc" * 50, b"x", b"hello"]
    model = lm.Spelling.fresh()
    lm.spelling_counts(words, model.counts)
    want, plain = model.cost(words), lm._positions
    monkeypatch.setattr(lm, "_positions", lambda w: plain(w, 7))
    assert np.allclose(model.cost(words), want)


def test_decisions_against_a_plain_loop():
    r = np.random.RandomState(3)
    texts = [r.randint(0, 5, n) for n in (1, 40, 0, 7, 90)]
    seen = lm.look_back(texts, np.arange(5) * 7)
    at = 0
    for number, t in enumerate(texts):
        hits = tries = run = 0
        for i, w in enumerate(t):
            last = max((j for j in range(i - 1) if t[j] == t[i - 1]), default=-1) if i else -1
            tried = last >= 0
            hit = tried and t[last + 1] == w
            assert (seen.text[at], seen.tried[at], seen.hit[at]) == (number, tried, hit)
            assert seen.rate[at] == np.log((hits + 0.4) / (tries - hits + 1.6))
            if tried:
                assert seen.slots[0, at] == min(run, lm.RUNS - 1)
                assert seen.slots[1, at] == lm.RUNS + t[i - 1] * 7 % lm.BEFORE
            tries, hits, run, at = tries + tried, hits + hit, run + 1 if hit else 0, at + 1


def test_online_weights_look_back_only():
    r = np.random.RandomState(1)
    x, y = r.randn(2, 300), (r.rand(300) < 0.5).astype(float)
    text = np.repeat([0, 1, 2], [100, 50, 150])
    args = (x, r.randint(0, 2, 300), 2)
    one = lm.online_mix(*args, y, text, 3, np.array([0.3, 0.1]), rate=0.5)
    other = y.copy()
    other[250:] = 1 - other[250:]
    two = lm.online_mix(*args, other, text, 3, np.array([0.3, 0.1]), rate=0.5)
    assert np.array_equal(one[:250], two[:250]) and not np.array_equal(one[290:], two[290:])


def test_base_score_and_gain(spark):
    texts = [t for pair in zip(syllable_texts(150, 4, (20, 200), 1000), syllable_texts(150, 5, (20, 200), 1000)) for t in pair]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(900, None, None, None, None), (901, " A b\tA ", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r for r in lm.score(docs.repartition(3), fold("doc_id", 7) == 2, block_bytes=20_000).collect()}
    tokens = {i: [*(t or "").lower().split(), None] for i, t, *_ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n = sum(c.values())
    gain = 0.0
    for i, ws in tokens.items():
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(w in c for w in ws), n)
        assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in ws)) < 1e-6
        assert r.score < 0 or len(ws) == 1
        if held[i]:
            gain += r.score - r.base_score
    assert gain > 0 and any(held.values())
    again = {r.doc_id: r.score for r in lm.score(docs.coalesce(1), fold("doc_id", 7) == 2, block_bytes=10 ** 7).collect()}
    assert all(abs(again[i] - out[i].score) < 0.02 * abs(out[i].score) + 0.01 for i in out)  # weights are averaged over tasks
    alone = lm.score(docs, F.lit(True)).collect()
    assert len(alone) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 for r in alone)


def test_very_long_words_cost_their_length(spark):
    r = np.random.RandomState(8)
    long = ["".join(map(chr, r.randint(97, 123, n))) for n in (60_000, 240_000)]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(long + syllable_texts(40, 5))]
    out = {x.doc_id: x for x in lm.score(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") < 2).where("doc_id < 2").collect()}
    assert 3.9 < out[1].score / out[0].score < 4.1
    assert all(x.bits_per_byte > 4 for x in out.values())


def test_kinds_come_from_all_training_texts(spark):
    """A kind of 12 texts among 2,512, none of which is among the 2,000 with the smallest hash of the id; kinds do not
    depend on how rows are dealt to tasks."""
    ids = [r.id for r in spark.range(2520).orderBy(F.xxhash64(F.col("id").cast("string"))).collect()]
    texts = syllable_texts(2500, 6, (30, 40), 60) + ["ka! lo! mi! nu! " * 9 + t for t in syllable_texts(20, 7, (5, 6), 9)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in zip(ids, texts)], SCHEMA)
    frame = docs.select(F.col("doc_id").alias("id"), F.col("doc_id").isin(*ids[-8:]).alias("held"), docs["text"].cast("binary").alias("text"))
    one, many = (lm._found_kinds(x, 2) for x in (frame.coalesce(1), frame.repartition(7)))
    near = np.sort((one @ lm._unit(lm.text_profiles([b"ka! lo! mi! nu! " * 9])).T)[:, 0])
    assert len(one) == 2 and near[0] < 0.2 and near[1] > 0.8
    assert np.allclose(one, many, atol=1e-6)


def test_profiles_against_a_plain_loop():
    texts = [b"", b"a b\ta  b a", b" \n ", b"longer-than-eight longer-than-seven", b"a" * 9 + b" b", b"x"]
    found = lm.text_profiles(texts)
    for t, row in zip(texts, found):
        count = collections.Counter((w[:8], len(w)) for w in t.split()).values()
        assert sorted(row[row > 0]) == sorted(round(255 * math.sqrt(n / max(count))) for n in count)
    assert np.array_equal(lm.text_profiles([b"b"])[0], lm.text_profiles([b"", b"b"])[1]) and (found[1] > 0)[found[4] > 0].sum() == 1


def test_equal_bytes_with_equal_contexts_are_worked_out_once(monkeypatch):
    words = [b"hello", b"yellow", "жук".encode(), b"", b"hello", b"ab" * 30] * 50
    worked, plain = [], lm._contexts
    monkeypatch.setattr(lm, "_contexts", lambda buf, at: worked.append(len(at)) or plain(buf, at))
    one, many = lm.Spelling.fresh(), lm.Spelling.fresh()
    lm.spelling_counts(words, many.counts)
    for w in words:
        lm.spelling_counts([w], one.counts)
    assert np.array_equal(one.counts, many.counts)
    whole = many.learn(words)
    worked.clear()
    together = many.cost(words)
    assert sum(worked) == len({(bytes(lm._PAD) + w + b" ")[i:i + lm._PAD + 1] for w in words for i in range(len(w) + 1)})
    assert np.array_equal(together, [many.cost([w])[0] for w in words])
    assert whole == sum(5 if b == 32 or 97 <= b <= 122 else 11 for w in words for b in w + b" ")


def test_online_mix_against_a_plain_loop():
    r = np.random.RandomState(5)
    sizes = [0, 70, 1, 32, 200, 33]
    text = np.repeat(np.arange(len(sizes)), sizes)
    for gates in (1, 3):
        x, gate, y, start = r.randn(4, len(text)), r.randint(0, gates, len(text)), (r.rand(len(text)) < 0.4).astype(float), r.randn(4)
        got = lm.online_mix(x, gate, gates, y, text, len(sizes), start, rate=0.1)
        at = 0
        for n in sizes:
            weights = np.tile(start, (gates, 1))
            for i in range(0, n, lm.STRIDE):
                step = np.zeros_like(weights)
                for j in range(at + i, at + min(i + lm.STRIDE, n)):
                    p = 1 / (1 + math.exp(-weights[gate[j]] @ x[:, j]))
                    assert abs(p - got[j]) < 1e-12
                    step[gate[j]] += (y[j] - p) * x[:, j]
                weights += 0.1 * step
            at += n


def test_dictionary_chances_against_a_plain_loop():
    r = np.random.RandomState(6)
    kind_counts = r.randint(0, 5, (9, 3)) * (np.arange(9) != 4)[:, None] * [1, 1, 0]     # word 4 is not listed, kind 2 has no text
    count, kind_tokens = kind_counts.sum(1).astype(float), kind_counts.sum(0).astype(float)
    shares = (kind_counts * 255 // np.maximum(kind_counts.sum(1, keepdims=True), 1)).astype(np.uint8)
    texts = [r.randint(0, 9, n) for n in (12, 0, 30, 1)]
    tokens = lm.look_back(texts, np.arange(9))
    size = np.array([len(t) for t in texts])
    got, n, at = lm.dictionary_chances(tokens, count, shares, kind_tokens, np.cumsum(size) - size), kind_tokens.sum(), 0
    for t in texts:
        belief = (kind_tokens + 1) / (n + 3)
        for w in t:
            own = np.where(kind_tokens > 0, count[w] * shares[w] / 255 / np.maximum(kind_tokens, 1), count[w] / n)
            p = 0.95 * own + 0.05 * count[w] / n
            assert abs(got[at] - belief @ p / belief.sum()) < 1e-12
            belief, at = belief * p / (belief * p).sum() if count[w] else belief, at + 1
    assert not lm.dictionary_chances(tokens, count * 0, shares, kind_tokens * 0, np.cumsum(size) - size).any()


def test_words_are_numbered_without_an_object_for_each():
    texts = [b"", b" a  b\ta\x0b", b"\n\x1c \xc2\xa0", b"b" * 50, b"   "]
    found, end = lm.Words.of(texts).tokens()
    words = lm._listed(found.dictionary)
    assert words == found.dictionary.to_pylist() == list(dict.fromkeys(w for t in texts for w in [*t.split(), b""]))
    assert [[words[i] for i in t] for t in np.split(found.indices.to_numpy(), end[:-1])] == [[*t.split(), b""] for t in texts]


def test_blocks_close_at_the_text_that_fills_them(spark):
    texts = syllable_texts(300, 9, (5, 30), 60)
    frame = spark.createDataFrame([(i, i % 7 == 2, t.encode()) for i, t in enumerate(texts)], "id long, held boolean, text binary").coalesce(1)
    frame = frame.select("id", "held", "text", F.spark_partition_id().alias("part"))
    rows = lm._blocks(frame, "bigint", 2_000, np.ones((1, lm.PROFILE), np.float32)).collect()
    words = {(r.block, r.number): (bytes(r.word), r.c0) for r in rows if r.kind == lm._WORD}
    full, trained = collections.Counter(), collections.Counter()
    for r in rows:
        if r.kind == lm._DOC:
            own = [words[r.block, w][0] for w in lm._unpacked(r.tokens)]
            assert own == [*texts[r.id].lower().encode().split(), b""] and r.held == (r.id % 7 == 2)
            trained.update((r.block, w) for w in own if not r.held)
            assert full[r.block] < 2_000
            full[r.block] += r.n_bytes + 64
    assert len([r for r in rows if r.kind == lm._DOC]) == 300 and sum(v < 2_000 for v in full.values()) <= 1
    assert all(trained[block, w] == c for (block, _), (w, c) in words.items())


def test_followers_against_a_plain_loop():
    r = np.random.RandomState(7)
    texts = [np.append(r.randint(1, 6, n), 0) for n in (40, 0, 7, 90, 40, 3)]       # word 0 is the end
    texts.append(texts[0])
    held = np.array([False, False, True, False, True, False, False])
    crc = (np.arange(6) * 2654435761 % 2 ** 32).astype(np.uint32)
    pairs, times = lm.block_pairs(texts, held, crc, 3)
    assert (np.diff(pairs.astype(np.int64)) > 0).all()

    def neighbours(t):
        return list(zip([0, *t[:-1]], t))

    trained = collections.Counter(p for t, h in zip(texts, held) if not h for p in neighbours(t))
    assert len(pairs) == len({p for t in texts for p in neighbours(t)}) and sorted(times[times > 0]) == sorted(trained.values())
    count = np.bincount(np.concatenate([t for t, h in zip(texts, held) if not h]), minlength=6).astype(float)
    found = lm.Followers.of(texts, lm.look_back(texts, np.arange(6)), held, count, crc, 3, pairs, times + 2.0 * (times > 0))
    at = 0
    for t, h in zip(texts, held):
        own, words = collections.Counter(neighbours(t)), collections.Counter(t.tolist())
        for u, w in neighbours(t):
            assert found.all[at] == count[u] - (not h) * words[u]
            assert found.same[at] == (trained[u, w] + 2 * (trained[u, w] > 0)) - (not h) * own[u, w]
            at += 1


def test_what_other_blocks_have_of_a_pair():
    keys, times = [np.array(x, np.uint32) for x in ([1, 5, 9], [5], [0, 9, 4_000_000_000])], [[2, 1, 0], [4], [1, 3, 1]]
    rows = pd.DataFrame({"block": [7, 8, 9], "part": [3] * 3, "keys": [lm._sorted_packed(k) for k in keys], "times": [lm._packed(np.array(t, np.uint32)) for t in times]})
    out = lm._others(rows)
    assert out["block"].tolist() == [7, 8, 9] and [lm._unpacked(x).tolist() for x in out["found"]] == [[0, 4, 3], [1], [0, 0, 0]]


def test_texts_that_occur_twice_are_scored_apart(spark):
    """All texts draw the same words; a copy, or a held-out copy, follows its original word by word, in whichever block that is."""
    r = np.random.RandomState(4)
    words = ["".join(r.choice(list("abdegiklmnorstu"), 5)) for _ in range(3000)]
    texts = [" ".join(r.choice(words, 120)) for _ in range(150)]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)] + [(1000 + i, texts[i], "en", "s", None) for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4, "doc_id")
    held = F.col("doc_id") >= 1020
    out = {x.doc_id: x for x in lm.score(docs, held, block_bytes=20_000).collect()}
    alone = min(out[i].bits_per_byte for i in range(30, 150))
    assert all(out[i].bits_per_byte < 0.6 * alone for i in [*range(20), *range(1000, 1030)])
    assert all(out[i].bits_per_byte > 0.6 * alone for i in range(20, 30))       # their copies are held out
    whole = {x.doc_id: x.score for x in lm.score(docs, held, block_bytes=10 ** 7).collect()}
    assert all(abs(whole[i] - out[i].score) < 1e-4 * abs(whole[i]) for i in out)
