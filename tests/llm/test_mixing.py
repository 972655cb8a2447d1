import random
from fractions import Fraction

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from hazegrid.llm import mixing, packing


def plain_schedule(c):
    """Earliest deadline first among released blocks, one slot after another; c: blocks of each source."""
    total, taken, out = sum(c), [0] * len(c), []
    for t in range(total):
        ready = [(-(-(taken[i] + 1) * total // n), i) for i, n in enumerate(c) if taken[i] < n and taken[i] * total // n <= t]
        deadline, i = min(ready)
        assert t < deadline
        out.append((i, taken[i]))
        taken[i] += 1
    return out


def test_schedule_against_simulation(spark):
    sources = [("a", 370, 500), ("b", 61, 70), ("c", 25, 125), ("d", 1, 30), ("e", 200, 75)]
    rows = mixing.schedule(spark.createDataFrame(sources, "key string, m long, w long"), 12).collect()
    total, start, k, expected = 800, 0, 0, []
    slots = max(12, -(-total // 30))
    upto = [sum(w for *_, w in sources[:i]) for i in range(6)]

    def dealt(k):
        return [min(m, k * slots * upto[i + 1] // total - k * slots * upto[i] // total) for i, (_, m, _) in enumerate(sources)]

    while start < sum(m for _, m, _ in sources):
        done, c = dealt(k), [b - a for a, b in zip(dealt(k), dealt(k + 1))]
        assert min(c) >= 0
        for t, (i, x) in enumerate(plain_schedule(c)):
            n = sum(c)
            expected.append((sources[i][0], done[i] + x, start + t, start + x * n // c[i], start - (-(x + 1) * n // c[i])))
        start, k = start + sum(c), k + 1
    assert sorted(map(tuple, rows)) == sorted(expected)
    assert all(r.release <= r.slot < r.deadline for r in rows)


def off_target(slots, share):
    """Half blocks between a source's count and its due, at most; ``slots`` are those it has, rising."""
    n = np.arange(len(slots))
    return max(np.abs(n - share * slots).max(), np.abs(n + 1 - share * (slots + 1)).max())


def test_no_drift_over_a_thousand_rounds(spark):
    shares = {"a": 0.6, "b": 0.3985, "c": 0.0015}
    slots = 667 * 1000
    sources = spark.createDataFrame([(k, int(slots * s) + 1, int(1e9 * s)) for k, s in shares.items()], "key string, m long, w long")
    plan = mixing.schedule(sources).toPandas()
    assert sorted(plan.slot) == list(range(len(plan))) and len(plan) > slots - 3
    plan = plan[plan.slot < slots - 667]        # all sources last that long
    for key, share in shares.items():
        mine = np.sort(plan[plan.key == key].slot.to_numpy())
        assert off_target(mine, share) < 2          # two half blocks: one block


def test_many_slow_sources_keep_their_targets(spark):
    r = random.Random(8)
    raw = [r.choice((1, 3, 40, 900)) + r.random() for _ in range(40)]
    w = [max(1000, round(1e9 * x / sum(raw))) for x in raw]
    long = 60_000
    sources = spark.createDataFrame([(f"s{i:02d}", long * x // sum(w) + 1, x) for i, x in enumerate(w)], "key string, m long, w long")
    plan = mixing.schedule(sources).toPandas()
    assert sorted(plan.slot) == list(range(len(plan)))
    plan = plan[plan.slot < long * 9 // 10]
    for i, x in enumerate(w):
        mine = np.sort(plan[plan.key == f"s{i:02d}"].slot.to_numpy())
        assert len(mine) == 0 or off_target(mine, x / sum(w)) < 2


def docs(spark):
    r = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else r.choice(["a", "b", "c", None])) for i in range(900)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string")


def test_deviation_stays_below_one_block(spark):
    rows, df = docs(spark)
    weights = {"hot": 1.0, "a": 4.0, "b": 2.0, "c": 1.0, None: 2.0}
    out = mixing.mix(df, weights=weights, block_docs=4, round_slots=20, group_rows=50).collect()
    assert sorted(r.doc_id for r in out) == list(range(900))
    assert len({(r.slot, r.place) for r in out}) == 900 and all(r.place in (0, 1) for r in out)
    order = [s for _, s in sorted({(r.slot, r.source) for r in out}, key=lambda x: x[0])]
    assert len(order) == max(r.slot for r in out) + 1
    halves = {s: -(-sum(1 for _, x in rows if x == s) // 2) for s in weights}
    count = dict.fromkeys(weights, 0)
    for t, s in enumerate(order, 1):
        if any(weights[x] * 2 * (t // 20 + 1) > halves[x] - 1 for x in weights):
            break  # a source runs out in this round
        count[s] += 1
        assert all(abs(count[x] - Fraction(weights[x]) / 10 * t) < 2 for x in weights)
    assert t > 100


def test_numbering_does_not_depend_on_groups(spark):
    _, df = docs(spark)
    one = mixing.mix(df, block_docs=4, group_rows=10 ** 6)
    many = mixing.mix(df.repartition(7), block_docs=4, group_rows=20)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_order_of_written_files_and_native_plan(spark, tmp_path):
    _, df = docs(spark)
    slots = {r.doc_id: (r.slot, r.place) for r in mixing.mix(df).collect()}
    out = mixing.in_mixed_order(df)
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()
    read = [slots[r.doc_id] for r in out.collect()]
    assert read == sorted(read)


def test_sequences_follow_the_mix_over_files_of_unequal_size(spark, tmp_path):
    r = random.Random(4)
    rows = [(i, " ".join(f"w{r.randrange(90)}" for _ in range(r.choice((3, 20, 200)))), "hot" if i % 3 else r.choice("ab")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    places = {x.doc_id: (x.slot, x.place) for x in mixing.mix(docs).collect()}
    for at, part in enumerate((docs.where("doc_id < 20"), docs.where("doc_id >= 20 and doc_id < 500"), docs.where("doc_id >= 500"))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/n={at}"))
    read = spark.read.parquet(str(tmp_path / "in")).select("doc_id", "text", "source")
    out = packing.pack_mixed(read, public_tokenizers.path("byte_bpe_50k.json"), block=50).collect()
    order = sorted({(places[x.doc_id], x.doc_id, x.piece): x.sequence_id // 51 for x in out}.items())
    assert len(order) == 600 and [b for _, b in order] == [i // 50 for i in range(600)]


def test_sequences_follow_the_order_that_the_mixing_stage_wrote(spark, tmp_path, monkeypatch):
    """Other weights in the mixing stage give other sequences; files of unequal size are not read in their order."""
    r = random.Random(4)
    rows = [(i, " ".join(f"w{r.randrange(90)}" for _ in range(r.choice((3, 20, 200)))), "hot" if i % 3 else r.choice("ab")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(corpus_pipeline.packing.pack, "__defaults__", (2048, 50))
    monkeypatch.setattr(corpus_pipeline.packing.pack_in_order, "__defaults__", ("doc_id", "text", 2048, 50))
    for weights in ({"a": 0.8, "b": 0.1, "hot": 0.1}, {"a": 0.1, "b": 0.1, "hot": 0.8}):
        places = {x.doc_id: (x.slot, x.place) for x in mixing.mix(docs, weights=weights).collect()}
        path = str(tmp_path / f"by{weights['a']}")
        ordered = mixing.in_mixed_order(docs, weights=weights)
        cuts = sorted(places.values())[19], sorted(places.values())[499]
        file = F.udf(lambda i: sum(places[i] > c for c in cuts), "int")
        ordered.repartitionByRange(3, file("doc_id")).sortWithinPartitions(file("doc_id"), F.udf(lambda i: places[i][0] * 100 + places[i][1], "int")("doc_id")).write.parquet(path)
        out = corpus_pipeline.pack(spark, spark.read.parquet(path), "").collect()
        order = sorted({(places[x.doc_id], x.doc_id): x.sequence_id // 51 for x in out}.items())
        assert len(order) == 600 and [b for _, b in order] == [i // 50 for i in range(600)]
    plain = corpus_pipeline.packing.pack_in_order(docs.repartition(3), public_tokenizers.path("byte_bpe_50k.json"))
    assert plain.count() == 600 and corpus_pipeline.pack(spark, docs.where("doc_id < 0"), "").count() == 0
