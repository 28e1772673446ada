import random
import re

import numpy as np

from recon360.llm import minmax

from messy_table import messy_rows


def brute_set(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + 2]) for i in range(len(words) - 1)) or frozenset([words[0]])


def brute_force(rows):
    """(doc_id, n_shingles, component_id, kept), by comparing all pairs."""
    sets = [brute_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    named = [ids.get(find(i)) for i in range(len(rows))]
    return sorted(((r[0], len(s), c, r[0] == c) for r, s, c in zip(rows, sets, named, strict=True)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_sets_are_the_distinct_pairs(monkeypatch):
    texts = [r[1] for r in messy_rows()] + ["a", "A b", "a b a b", "a  b\nC d", "x " * 9000]
    whole = [minmax.shingle_set(t, minmax._Words()) for t in texts]
    assert [len(s) for s in whole] == [len(brute_set(t)) for t in texts]
    monkeypatch.setattr(minmax, "_SLICE", 7)  # cut into many slices
    for text, expected in list(zip(texts, whole, strict=True))[-5:]:
        assert np.array_equal(minmax.shingle_set(text, minmax._Words()), expected)


def test_both_ends_of_a_permutation_estimate_the_similarity():
    rng = np.random.default_rng(4)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 64, 300, np.uint64)
        a, b = np.unique(pool[:250]), np.unique(pool[50:])  # 200 of 300
        (a_low, a_high), (b_low, b_high) = minmax.signature(a), minmax.signature(b)
        errors += [(a_low == b_low).mean() - 2 / 3, (a_high == b_high).mean() - 2 / 3]
    assert abs(np.mean(errors)) < 0.02
    values = (np.uint32(7) * minmax._permutations()[0] + minmax._permutations()[1]).ravel()
    low, high = minmax.signature(np.array([7 << 32], np.uint64))
    assert np.array_equal(low, values) and np.array_equal(high, values)


def test_sets_at_the_threshold_share_a_band_and_most_bits():
    rng = np.random.default_rng(9)
    for size in (5, 10, 100, 1000) * 100:
        pool = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
        rng.shuffle(pool)
        tenth = size // 10 if size >= 10 else 0  # shared: 80 of 100; of five, four
        a, b = (np.sort(pool[: size - tenth]), np.sort(pool[tenth:])) if tenth else (np.sort(pool[:4]), np.sort(pool))
        x, y = minmax.signature(a), minmax.signature(b)
        assert set(minmax.band_keys(*x).tolist()) & set(minmax.band_keys(*y).tolist())
        agree = 256 - sum((int(p) ^ int(q)).bit_count() for p, q in zip(minmax.sketch(*x).view(np.uint64), minmax.sketch(*y).view(np.uint64), strict=True))
        assert agree >= minmax.AGREEING_BITS


def _documents():
    """Groups of copies with some words changed, more and less than the threshold allows, and short texts."""
    random.seed(12)
    rows, doc_id = [], 900
    for g in range(12):
        base = [f"g{g}w{random.randrange(60)}" for _ in range(60)]
        for _ in range(25):
            words = list(base)
            for _ in range(random.choice([0, 1, 2, 3, 4, 6])):
                words[random.randrange(60)] = f"x{random.randrange(1000)}"
            rows.append((doc_id, " ".join(words)))
            doc_id -= 1
    short = ["a b c d e f", "a b c d e", "a b c d", "A B", "a b", "a", "A", "", None, " \n", "b a"]
    return rows + [(i, t) for i, t in enumerate(short)] + [(None, "a b"), (None, None), (None, "lone pair here"), (3, "other text")]


def test_components_match_all_pairs(spark, work, monkeypatch):
    rows = _documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(rows)
    assert 12 < len({c for _, _, c, _ in expected}) < len(rows) - 100
    monkeypatch.setattr(minmax, "BLOCK_NODES", 7)
    for many in (16, 4, 0):  # by pairs, in blocks where more are left, and in blocks alone
        monkeypatch.setattr(minmax, "MANY", many)
        assert got(minmax.near_duplicates(docs, type(work)(spark, work.path(f"many{many}")))) == expected


def test_blocks_join_what_is_similar(spark, work, monkeypatch):
    rng = random.Random(5)
    bases = [rng.sample(range(80), 20) for _ in range(15)]
    sets = [(i, sorted({*bases[i % 15][rng.randint(0, 3) :], *rng.sample(range(80), rng.randint(0, 3))})) for i in range(300)]
    similar = [(i, j) for i, a in sets for j, b in sets if i < j and 100 * len({*a} & {*b}) >= 80 * len({*a} | {*b})]
    table = spark.createDataFrame(sets, "node long, shingles array<long>")
    crowded = table.selectExpr("1L as hub", "node", "node as root").unionByName(table.selectExpr("2L as hub", "node", "node as root").where("node < 5"))
    monkeypatch.setattr(minmax, "BLOCK_NODES", 40)
    found = {(min(r), max(r)) for r in minmax._links_in_crowds(crowded, table, work).collect()}
    assert found == set(similar) and len(similar) > 100
    # of each two components one link is enough
    joined = crowded.selectExpr("hub", "node", "node div 60 as root")
    found = {(min(r), max(r)) for r in minmax._links_in_crowds(joined, table, type(work)(spark, work.path("joined"))).collect()}
    roots = {(i // 60, j // 60) for i, j in similar if i // 60 != j // 60}
    assert found <= set(similar) and {(i // 60, j // 60) for i, j in found} == roots and len(found) < len(similar)


def test_messy_table(spark, messy, nothing, work):
    assert got(minmax.near_duplicates(messy, work)) == brute_force(messy_rows())
    assert minmax.near_duplicates(nothing, type(work)(spark, work.path("none"))).count() == 0


def test_a_group_of_copies_is_one_node(spark, work):
    base = " ".join(f"w{i}" for i in range(50))
    rows = [(i, base) for i in range(3000)] + [(5000 + i, base + f" v{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.component_id, r.n) for r in minmax.near_duplicates(docs, work).groupBy("component_id").count().withColumnRenamed("count", "n").collect()} == {(0, 3040)}
    assert spark.read.parquet(work.path("nodes")).count() == 41
