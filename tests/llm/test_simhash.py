import random

import numpy as np
import xxhash

from hazegrid.llm import simhash
from hazegrid.llm.components import components
from tests.llm.helpers import SCHEMA, syllable_texts


def plain_fingerprint(text, words):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\n", " ").split(" ") if x]
    if not w:
        return 0
    parts = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(ids, linked):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: top(i) for i in ids}


def edited(text, n, r):
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(1000)}"
    return " ".join(w)


def some_docs(spark, seed=1):
    r = random.Random(seed)
    texts = syllable_texts(60, seed, (80, 400))
    texts += [edited(texts[i % 9], r.randint(1, 12), r) for i in range(50)] + texts[:30] + ["", None, "Solo", "solo"]
    return texts, spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], SCHEMA)


def test_components_against_search(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 470)] + [(500, i) for i in range(501, 560)]
    found = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = sorted({i for e in edges if e[0] != e[1] for i in e})
    both = {frozenset(e) for e in edges}
    assert found == roots(ids, lambda a, b: frozenset((a, b)) in both)


def test_fingerprints_and_groups_against_brute_force(spark):
    texts, docs = some_docs(spark)
    prints = [plain_fingerprint(t or "", 3) for t in texts]
    for radius, tile in ((2, 4096), (4, 8)):  # the small tile cuts buckets into many tile pairs
        rows = {r.doc_id: r for r in simhash.near_duplicates(docs, radius=radius, tile=tile).collect()}
        assert all(rows[i].fingerprint == f"{p:016x}" for i, p in enumerate(prints))
        want = roots(range(len(texts)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= radius)
        assert {i: r.component_id for i, r in rows.items()} == want


def test_one_of_each_group_against_brute_force(spark):
    texts, docs = some_docs(spark, 3)
    prints = [plain_fingerprint(t or "", 3) for t in texts]
    want = roots(range(len(texts)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    left = simhash.one_of_each_group(docs, tile=16).collect()
    assert {r.doc_id for r in left} == set(want.values()) and len(left) < len(texts) - 30
    assert all(r.text == texts[r.doc_id] for r in left)


def test_many_copies_make_no_pairs(spark):
    copies = [(i, "the same text over and over again", "en", "s", None) for i in range(3000)]
    rows = simhash.near_duplicates(spark.createDataFrame(copies, SCHEMA)).collect()
    assert len(rows) == 3000 and {r.component_id for r in rows} == {0}


def test_spanning_forest_joins_the_same():
    r = np.random.RandomState(0)
    pairs = r.randint(0, 400, (300, 2))
    kept = simhash.spanning(pairs)
    ids = np.unique(pairs).tolist()
    every, some = ({frozenset(p) for p in x.tolist()} for x in (pairs, kept))
    tree = roots(ids, lambda a, b: frozenset((a, b)) in some)
    assert some <= every and tree == roots(ids, lambda a, b: frozenset((a, b)) in every)
    assert len(kept) == len(ids) - len(set(tree.values())) and not len(simhash.spanning(pairs[:0]))


def test_blocks_meet_all_pairs_within_the_radius():
    blocks = simhash.exact_blocks(64, 2)
    assert sorted(b for block in blocks for b in block) == list(range(64)) and len(blocks) == 3


def test_a_chain_of_links_is_one_group(spark):
    """Near fingerprints in a row: the ends are far from each other, the group is one."""
    prints = [0]
    for i in range(40):
        prints.append(prints[-1] ^ (1 << i))
    rows = [(p.to_bytes(8, "big"), (False, i, 0)) for i, p in enumerate(prints)]
    classes = spark.createDataFrame(rows, "fp binary, least struct<no_id:boolean,id:bigint,text_hash:bigint>")
    for tile in (4096, 4):
        found = simhash.groups(classes, simhash.links(classes, 2, simhash.exact_blocks(64, 2), tile)).collect()
        assert len(found) == 41 and {r["first"].id for r in found} == {0}
