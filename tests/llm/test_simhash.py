import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from recon360.llm import simhash

from messy_table import messy_rows


def brute_fingerprint(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """Smallest id reachable, by comparing all pairs."""
    prints = [brute_fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 2 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[root[i]] = min(ids.get(root[i], r[0]), r[0])
    return [(r[0], f"{p:016x}", ids.get(c)) for r, p, c in zip(rows, prints, root, strict=True)]


def test_fingerprints(monkeypatch):
    texts = [r[1] for r in messy_rows()] + ["a", "A b", "a b c", "a  b\nC d", "x " * 9000]
    whole = [simhash.fingerprint(t) for t in texts]
    assert whole == [brute_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "_SLICE", 7)  # cut into many slices
    assert [simhash.fingerprint(t) for t in texts[-5:] + texts[:8]] == whole[-5:] + whole[:8]


def test_spark_hashes_shingles_alike(spark):
    hashed = spark.range(1).select(F.xxhash64(F.lit("der die das")).alias("h")).first().h
    assert hashed % 2**64 == xxhash.xxh64_intdigest("der die das".encode(), 42)


def test_golay_code_is_perfect():
    rng = np.random.default_rng(1)
    index = rng.integers(0, 1 << 12, 2000)
    words = (index << 11) | simhash._PARITY[index]
    for k in range(4):
        noisy = words.copy()
        for i in range(len(noisy)):
            for b in rng.choice(23, k, replace=False):
                noisy[i] ^= 1 << int(b)
        assert np.array_equal(simhash.golay_index(noisy), index)
    counts = (simhash.golay_indices(rng.integers(0, 1 << 23, 5000)) >= 0).sum(axis=1)
    assert set(counts.tolist()) == {1, 6}


def test_close_fingerprints_share_a_key():
    random.seed(3)
    for _ in range(3000):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), random.randint(0, 2)):
            b ^= 1 << bit
        (_, x), (_, y) = (simhash.fuzzy_keys(np.array([simhash._signed(v)], np.int64)) for v in (a, b))
        assert set(x.tolist()) & set(y.tolist()) and len(x) <= 18


def _close_docs():
    """Texts of two or three words whose fingerprints are near each other, found by trying."""
    random.seed(8)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(random.randint(0, 2)):
            words[random.randrange(400)] = f"v{random.randrange(50)}"
        rows.append((1000 - i, " ".join(words)))
    return rows + [(5, ""), (4, None), (9, "a"), (3, "A")]


def test_components_match_all_pairs(spark, work, monkeypatch):
    rows = _close_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted(brute_components(rows))
    assert len({c for _, _, c in expected}) < len(rows) - 50
    for many in (64, 1):  # by pairs, and through neighbours
        monkeypatch.setattr(simhash, "MANY", many)
        got = simhash.near_duplicates(docs, type(work)(spark, work.path(f"many{many}")))
        assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == expected


def test_messy_table(spark, messy, nothing, work):
    got = simhash.near_duplicates(messy, work).collect()
    expected = brute_components(messy_rows())
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=str) == sorted(expected, key=str)
    assert simhash.near_duplicates(nothing, type(work)(spark, work.path("none"))).count() == 0
