from recon360.operators import survivors
from recon360.operators.dedup import business_columns

FIELDS = "customer_id string, first_name string, last_name string, email string, phone string, country string, state string, signup_date string, loyalty_tier string"
ROWS = [
    ("C1", "a", "b", "", "1", "USA", "", "2020-01-01", "Silver"),
    ("C2", "a", "b", "e2", "1", "USA", "IL", "01/02/2024", ""),
    ("C3", "a", "b", "e3", "", "USA", "TX", "not a date", "GOLD"),
    ("C4", "z", "z", "", "", "", None, "", ""),
]


def _elected(spark, strategy):
    customers = spark.createDataFrame(ROWS, FIELDS)
    crosswalk = spark.createDataFrame([("C2", "C1"), ("C3", "C1")], "old_customer_id string, canonical_customer_id string")
    elected = survivors.elect(customers, crosswalk, survivors.STRATEGIES[strategy])
    people = {r.customer_id: r for r in survivors.surviving_customers(customers, crosswalk, elected).collect()}
    moved = {(r[0], r[1]) for r in survivors.rerooted(crosswalk, elected).collect()}
    return people, moved, crosswalk


def test_strategies_elect_and_fill(spark):
    expected = {"smallest_id": "C1", "most_complete": "C2", "latest_signup": "C2", "highest_tier": "C3"}
    for strategy, survivor in expected.items():
        people, moved, _ = _elected(spark, strategy)
        assert set(people) == {survivor, "C4"}
        assert (people[survivor].n_merged, people["C4"].n_merged) == (3, 1)
        assert moved == {(c, survivor) for c in ("C1", "C2", "C3") if c != survivor}
    assert moved == {("C1", "C3"), ("C2", "C3")}
    tier = people["C3"]
    assert (tier.email, tier.phone, tier.state, tier.loyalty_tier) == ("e3", "1", "TX", "GOLD")
    assert tier.signup_date == "not a date"  # filled is what is not blank


def test_blanks_come_from_the_next_best_row(spark):
    people, _, _ = _elected(spark, "latest_signup")
    best = people["C2"]
    assert (best.email, best.state, best.signup_date, best.loyalty_tier) == ("e2", "IL", "01/02/2024", "Silver")
    assert people["C4"].state is None


def test_the_default_is_the_crosswalk_itself(spark):
    people, moved, crosswalk = _elected(spark, "smallest_id")
    assert moved == {(r[0], r[1]) for r in crosswalk.collect()} and people["C1"].email == "e2"


def test_no_component_at_all(spark):
    customers = spark.createDataFrame(ROWS, FIELDS)
    none = spark.createDataFrame([], "old_customer_id string, canonical_customer_id string")
    elected = survivors.elect(customers, none, survivors.smallest_id)
    assert elected.count() == 0
    rows = survivors.surviving_customers(customers, none, elected).collect()
    assert sorted(r.customer_id for r in rows) == ["C1", "C2", "C3", "C4"] and rows[0].asDict().keys() >= set(business_columns(customers))
