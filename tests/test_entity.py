import random
from itertools import combinations

import pytest

from recon360.operators import entity

COLUMNS = "customer_id string, first_name string, last_name string, phone string, email string"


def brute_force(rows):
    """Smallest id reachable over pairwise matches."""
    norm = {
        r[0]: (f"{r[1].strip().lower()} {r[2].strip().lower()}", r[3].strip(), r[4].strip().lower()) for r in rows
    }
    near = {i: set() for i in norm}
    for a, b in combinations(norm, 2):
        (na, pa, ea), (nb, pb, eb) = norm[a], norm[b]
        if na == nb and ((pa and pa == pb) or (ea and ea == eb)):
            near[a].add(b)
            near[b].add(a)
    out = {}
    for start in sorted(norm):
        if start in out:
            continue
        todo = [start]
        while todo:
            at = todo.pop()
            if at not in out:
                out[at] = start
                todo += near[at]
    return {i: root for i, root in out.items() if i != root}


def crosswalk(spark, store, rows):
    df = spark.createDataFrame(rows, COLUMNS)
    found = entity.id_crosswalk(entity.match_keys(df), store).collect()
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: r[1] for r in found}


@pytest.mark.parametrize("seed", range(3))
def test_random_customers(spark, store, seed):
    rng = random.Random(seed)
    rows = [
        (f"C{i:03}", rng.choice(["Ann", " ann", "Bob"]), "Lee", rng.choice(["", "1", "2", "3", "4"]) if i % 3 else f"p{i}",
         rng.choice(["", "a@x", "A@x ", "b@x"]) if i % 4 == 0 else f"e{i // 2}")
        for i in rng.sample(range(500), 60)
    ]
    assert crosswalk(spark, store, rows) == brute_force(rows)


@pytest.mark.parametrize("order", ["sorted", "mixed"])
def test_long_chain_takes_few_rounds(spark, store, order):
    """Customer i shares its phone with one neighbour and its email with the other."""
    n = 200
    ids = [f"C{i:04}" for i in range(n)]
    if order == "mixed":
        random.Random(3).shuffle(ids)
    rows = [(c, "Ann", "Lee", f"p{(i + 1) // 2}", f"e{i // 2}") for i, c in enumerate(ids)]
    written = []

    def counting(name, df):
        written.extend([name] if name.startswith("links") else [])
        return store(name, df)

    assert crosswalk(spark, counting, rows) == {f"C{i:04}": "C0000" for i in range(1, n)}
    assert len(written) <= 10


def test_no_duplicates_at_all(spark, store):
    assert crosswalk(spark, store, [("C1", "Ann", "Lee", "1", "a"), ("C2", "Bob", "Lee", "1", "a")]) == {}


def test_blank_contacts_never_match_and_blank_names_do(spark, store):
    rows = [("C1", "Ann", "Lee", "", ""), ("C2", "Ann", "Lee", " ", ""), ("C3", "", "", "9", ""), ("C4", " ", "", "9", "x")]
    assert crosswalk(spark, store, rows) == {"C4": "C3"}


def test_hot_key_links_are_linear(spark, store):
    """A third of all ids share one name and phone: one link per id, not one per pair."""
    rows = [(f"C{i:05}", "Ann", "Lee", "1" if i % 3 == 0 else f"p{i}", f"e{i}") for i in range(3000)]
    links = entity.shared_key_links(entity.match_keys(spark.createDataFrame(rows, COLUMNS)), store)
    assert links.count() == 999 and links.select("linked_id").distinct().count() == 1


def test_match_kinds_are_a_parameter(spark, store):
    rows = [("C1", "Ann", "Lee", "1", "a"), ("C2", "Ann", "Lee", "1", "b"), ("C3", "Ann", "Lee", "2", "a")]
    keys = entity.match_keys(spark.createDataFrame(rows, COLUMNS))
    only_email = entity.id_crosswalk(keys, store, {"email": "match_email"}).collect()
    assert [tuple(r) for r in only_email] == [("C3", "C1")]


def test_merge_flag(spark):
    customers = spark.createDataFrame([("C1",), ("C2",), ("C3",)], "customer_id string")
    walk = spark.createDataFrame([("C3", "C1")], "old_customer_id string, canonical_customer_id string")
    got = {r[0]: r[1] for r in entity.with_merge_flag(customers, walk).collect()}
    assert got == {"C1": 1, "C2": 0}
    clusters = {r[0]: r[1] for r in entity.entity_clusters(customers, walk).collect()}
    assert clusters == {"C1": "C1", "C2": "C2", "C3": "C1"}
