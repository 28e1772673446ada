"""The whole job on a small hand-made shop whose answers are worked out by hand."""

import json
import random
from collections import Counter

import pytest

from recon360.model import SEQ, Staging
from recon360.operators import references
from recon360.plans import answers, job, rules
from recon360.plans.conform import Customer360

FILES = {
    "customers.csv": [
        "customer_id,first_name,last_name,email,phone,country,state,signup_date,loyalty_tier",
        "K1,Ida,Holm,ida@a.org,10,US,Texas,01/02/2024,Gold",
        'K2,Jon,"Ek, Jr",,20,USA,NV,2024/01/03,',
        "K3,Ola,Berg,ola@a.org,30,Canada,Ontario,soon,Silver",
        "K3,Ola,Berg,OLA2@a.org,31,Canada,Ontario,soon,Gold",
        "K4, ida,HOLM ,other@a.org,10,United States,TX,2024-02-01T00:00:00Z,Bronze",
        "K5,Ida,Holm,OTHER@A.ORG,50,usa,texas,2024-02-02,Bronze",
        "K6,Ulf,Dahl,ulf@a.org,10,USA,ny,03-04-2024,Gold",
        "K7,Eva,Lind,,,USA,CA,2024-05-01,",
        "K7,Eva,Lind,eva@a.org,,USA,CA,2024-05-01,",
    ],
    "products.csv": [
        "product_id,product_name,category,unit_price,active_flag",
        "A,Pen,Office,$2.50,Y",
        "B,Ink,Office,10.00,no",
        "C,Pad,Office,n/a,",
    ],
    "orders.csv": [
        "order_id,customer_id,order_ts,product_id,quantity,order_status,shipping_state,order_total",
        "1,K1,2024-06-01 10:00:00,A,4,completed,Texas,10.00",
        "1,K6,2024-06-02 10:00:00,A,4,completed,TX,99.00",
        "2,K5,06/15/2024 10:00,B,2,Completed,tx,20.00",
        "3,K9,2024/07/01 10:00,A,2,completed,NV,5.00",
        "3,K8,2024/07/01 10:00,A,2,completed,NV,5.00",
        "4,K2,2024-07-02T10:00:00Z,Z,1,completed,,7.00",
        "5,K3,07-03-2024 10:00,A,two,completed,Ontario,5.00",
        '6,K3,never,A,-1,cancelled,NY,"1,000.00"',
        "7,K6,2024-07-05 10:00,C,1,completed,NY,3.00",
        "8,K6,2024-07-06 10:00,A,2,completed,NY,5.01",
    ],
    "payments.csv": [
        "payment_id,order_id,payment_ts,payment_method,payment_status,amount",
        "p1,1,2024-06-01 10:01,card,settled,10.00",
        "p2,2,2024-06-15 10:01,card,Settled,15.00",
        "p3,2,2024-06-15 10:02,card,settled,5.00",
        "p4,77,2024-06-15 10:02,card,settled,5.00",
        "p5,6,2024-06-15 10:02,card,voided,0.00",
        "p6,8,2024-07-06 10:01,card,settled,5.00",
    ],
}
TICKETS = [
    {"ticket_id": "t1", "customer_id": "K4", "created_ts": "2024-07-01T08:00:00", "sentiment": "Negative", "category": "billing"},
    {"ticket_id": "t2", "customer_id": "K9", "created_ts": "yesterday", "sentiment": "negative", "category": "return"},
    {"ticket_id": "t3", "customer_id": "K6", "created_ts": None, "sentiment": "neutral"},
    {"ticket_id": "t4", "customer_id": "K6", "created_ts": "2024-07-02", "sentiment": "negative", "category": "billing", "extra": 1},
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("input")
    for name, lines in FILES.items():
        (path / name).write_text("\n".join(lines) + "\n")
    (path / "support_tickets.jsonl").write_text("\n".join(json.dumps(t) for t in TICKETS) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def out_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("output"))


@pytest.fixture(scope="module")
def out(spark, folder, out_dir):
    return job.run(spark, folder, out_dir)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_customers(out):
    got = {r[0]: r[1:] for r in rows(out["dim_customer"].selectExpr("*", "cast(signup_date as string) d"),
           "customer_key", "full_name", "email", "phone", "standard_country", "standard_state", "d", "loyalty_tier", "duplicate_resolution_flag")}
    assert got == {
        "K1": ("Ida Holm", "ida@a.org", "10", "USA", "TX", "2024-01-02", "Gold", 1),
        "K2": ("Jon Ek, Jr", None, "20", "USA", "NV", "2024-01-03", "", 0),
        "K3": ("Ola Berg", "ola@a.org", "30", "Canada", "Ontario", None, "Silver", 0),
        "K6": ("Ulf Dahl", "ulf@a.org", "10", "USA", "NY", "2024-03-04", "Gold", 0),
        "K7": ("Eva Lind", "eva@a.org", None, "USA", "CA", "2024-05-01", "", 0),
    }
    # K1 and K4 share name and phone, K4 and K5 name and email
    assert sorted(rows(out["id_crosswalk"], "*")) == [("K4", "K1"), ("K5", "K1")]


def test_orders(out):
    got = {r[0]: r[1:] for r in rows(out["fact_order"].selectExpr("*", "cast(order_date as string) d", "cast(calculated_order_amount as double) c", "cast(order_amount_variance as double) v"),
           "order_key", "customer_key", "product_key", "d", "quantity", "shipping_state", "c", "v")}
    assert got == {
        "1": ("K1", "A", "2024-06-01", 4, "TX", 10.0, 0.0),
        "2": ("K1", "B", "2024-06-15", 2, "TX", 20.0, 0.0),
        "3": (None, "A", "2024-07-01", 2, "NV", 5.0, 0.0),
        "4": ("K2", None, "2024-07-02", 1, "", None, None),
        "5": ("K3", "A", "2024-07-03", None, "Ontario", None, None),
        "6": ("K3", "A", None, -1, "NY", -2.5, 1002.5),
        "7": ("K6", "C", "2024-07-05", 1, "NY", None, None),
        "8": ("K6", "A", "2024-07-06", 2, "NY", 5.0, 0.01),
    }


def test_payments_and_tickets(out):
    assert dict(rows(out["fact_payment"], "payment_key", "order_key")) == {"p1": "1", "p2": "2", "p3": "2", "p4": None, "p5": "6", "p6": "8"}
    got = {r[0]: r[1:] for r in rows(out["fact_customer_issue"].selectExpr("*", "cast(created_date as string) d"), "ticket_id", "customer_key", "d", "issue_category", "channel")}
    assert got == {
        "t1": ("K1", "2024-07-01", "billing", None),
        "t2": (None, None, "return", None),
        "t3": ("K6", None, None, None),
        "t4": ("K6", "2024-07-02", "billing", None),
    }


def test_exceptions(out):
    got = Counter(rows(out["dq_exception_report"], "rule_id", "record_key", "issue_description"))
    want = [
        ("DQ001", "K3", "customer_id K3 appears 2 times in source (exact duplicate rows)"),
        ("DQ001", "K7", "customer_id K7 appears 2 times in source (exact duplicate rows)"),
        ("DQ002", "K2", "Customer K2 has no email address on record"),
        ("DQ003", "K1", "Customer K1 country 'US' is a non-standard variant; should be 'USA'"),
        ("DQ003", "K1", "Customer K1 state 'Texas' is a full name; should use two-letter code"),
        ("DQ003", "K4", "Customer K4 country 'United States' is a non-standard variant; should be 'USA'"),
        ("DQ003", "K5", "Customer K5 state 'texas' is a full name; should use two-letter code"),
        ("DQ004", "1", "order_id 1 appears 2 times in source (exact duplicate rows)"),
        ("DQ004", "3", "order_id 3 appears 2 times in source (exact duplicate rows)"),
        ("DQ005", "3", "Order 3 references non-existent customer_id 'K9'"),
        ("DQ005", "3", "Order 3 references non-existent customer_id 'K8'"),
        ("DQ006", "4", "Order 4 references non-existent product_id 'Z'"),
        ("DQ007", "5", "Completed order 5 has non-positive quantity None (gross total: 5.0)"),
        ("DQ008", "6", "Order 6 stated total 1000.0 does not match computed -2.5 (variance: 1002.5)"),
        ("DQ009", "p4", "Payment p4 references non-existent order_id '77'"),
        ("DQ010", "p2", "Payment p2 settled amount 15.0 does not match completed order 2 total 20.0"),
        ("DQ010", "p3", "Payment p3 settled amount 5.0 does not match completed order 2 total 20.0"),
        ("DQ011", "t2", "Ticket t2 has unparseable created_ts: 'yesterday'"),
        ("DQ012", "t2", "Ticket t2 references non-existent customer_id 'K9'"),
        ("DQ013", "K4", "customer_id K4 resolves to the same person as canonical customer K1 (matching full_name + phone or email)"),
        ("DQ013", "K5", "customer_id K5 resolves to the same person as canonical customer K1 (matching full_name + phone or email)"),
        ("DQ014", "2", "Order 2 references inactive product B (active_flag = 0)"),
    ]
    assert got == Counter(want)


def test_reports(out):
    counts = dict(rows(out["dq_summary"], "rule_id", "n_exceptions"))
    assert len(counts) == 14 and sum(counts.values()) == 22 and counts["DQ003"] == 4
    assert rows(out["dq_totals"], "*") == [(22, 14, 14, 0)]
    detail = rows(out["dq_detail"], "rule_id", "status", "record_key")
    assert ("DQ010", "2 exception(s)", "p3") in detail and len(detail) == 22
    assert {r[0] for r in rows(out["answers"], "state")} == {"ok"}


def test_checks(out):
    failed = {r[0] for r in rows(out["checks"].where("not passed"), "check_name")}
    # one unreadable order date is in the data, and one unreadable price of a product that counts as active
    assert failed == {"order_date_missing", "unit_price_missing", "active_price_not_positive"}


def conformed(spark, folder, store, seed=None):
    from recon360.sources import files

    tables = {}
    for name, file in job.SOURCES.items():
        scan = files.scan_csv if file.endswith("csv") else files.scan_jsonl
        df = files.with_columns(scan(spark, f"{folder}/{file}"), ["channel", "description"] if name == "support_tickets" else [])
        if seed is not None:
            data = df.collect()
            random.Random(seed).shuffle(data)
            df = spark.createDataFrame(data, df.schema).repartition(3)
        tables[name] = df
    return Customer360(Staging(**tables), store)


def test_answers(spark, folder, store):
    t = conformed(spark, folder, store)
    assert rows(answers.revenue_by_month(t), "*") == [("2024-06", 30.0), ("2024-07", 25.01)]
    assert rows(answers.top_customers(t), "*") == [
        ("K1", "Ida Holm", 30.0), ("K6", "Ulf Dahl", 8.01), ("K2", "Jon Ek, Jr", 7.0), ("K3", "Ola Berg", 5.0),
    ]
    assert rows(answers.top_customers(t, 1), "customer_key") == [("K1",)]
    assert rows(answers.revenue_by_state(t), "*") == [("TX", 30.0), ("NY", 8.01), ("", 7.0), ("NV", 5.0), ("Ontario", 5.0)]
    flags = ["invalid_customer", "invalid_product", "suspicious_qty", "total_mismatch", "missing_payment", "payment_mismatch"]
    got = [(r["order_key"], {f for f in flags if r[f] == "Yes"}) for r in answers.problem_orders(t).collect()]
    assert got == [
        ("2", {"payment_mismatch"}), ("2", {"payment_mismatch"}), ("3", {"invalid_customer", "missing_payment"}),
        ("4", {"invalid_product", "missing_payment"}), ("5", {"missing_payment"}), ("6", {"total_mismatch"}), ("7", {"missing_payment"}),
    ]
    assert rows(answers.tickets_vs_exceptions(t), "*") == [
        ("t1", "K1", "Ida Holm", "billing", 2, 0, 0, 2, 0),
        ("t4", "K6", "Ulf Dahl", "billing", 2, 0, 1, 0, 0),
        ("t2", None, "Unknown", "return", 0, 0, 0, 0, 0),
    ]


@pytest.mark.parametrize("seed", [1])
def test_row_order_on_disk_does_not_matter(spark, folder, tmp_path, seed):
    from recon360.model import DEFAULT_RULES
    from recon360.sources.store import TableStore

    plain = conformed(spark, folder, TableStore(spark, str(tmp_path / "a")))
    mixed = conformed(spark, folder, TableStore(spark, str(tmp_path / "b")), seed)
    for name, df in plain.curated().items():
        assert sorted(map(str, df.collect())) == sorted(map(str, mixed.curated()[name].collect()))
    found = [sorted(map(str, rules.exceptions(t, DEFAULT_RULES).collect())) for t in (plain, mixed)]
    assert found[0] == found[1]


def test_running_again_gives_the_same(spark, folder, out, out_dir):
    first = {n: sorted(map(str, df.collect())) for n, df in out.items()}
    second = {n: sorted(map(str, df.collect())) for n, df in job.run(spark, folder, out_dir).items()}
    assert first == second


def test_repeated_payment_id_fails_the_run(spark, folder, tmp_path):
    import shutil

    copy = tmp_path / "in"
    shutil.copytree(folder, copy)
    with open(copy / "payments.csv", "a") as f:
        f.write("p1,1,2024-06-01 10:01,card,settled,10.00\n")
    with pytest.raises(ValueError, match="fact_payment"):
        job.run(spark, str(copy), str(tmp_path / "out"))


def test_one_failing_answer_does_not_stop_the_others(spark, folder, store, tmp_path, monkeypatch):
    t = conformed(spark, folder, store)

    def broken(_):
        raise RuntimeError("no such column")

    monkeypatch.setitem(answers.ANSWERS, "bq2_top_customers", broken)
    states = job.write_answers(t, ["q"] * 5, str(tmp_path / "out"))
    assert states.pop("bq2_top_customers") == "no such column" and set(states.values()) == {"ok"}


def test_tickets_answer_against_the_plain_joins(spark, store):
    """One customer holds a third of the tickets, orders and payments; a ticket id repeats."""
    rng = random.Random(11)
    pick = lambda n: 0 if rng.random() < 0.34 else rng.randrange(n)
    orders = [(f"O{i}", rng.choice(["completed", "Completed", "cancelled"]), f"C{pick(8)}" if i % 9 else None, rng.choice([None, -1, 0, 2]),
               rng.choice([None, "10.00", "12.50"]), rng.choice([None, "0.01", "0.02", "-3.00"])) for i in range(90)]
    pays = [(f"P{i}", f"O{pick(60)}" if i % 11 else None, rng.choice(["settled", "voided"]), rng.choice([None, "10.00", "12.51"])) for i in range(120)]
    tickets = [(f"T{i % 50}", f"C{pick(10)}" if i % 7 else None, rng.choice(["a", "b"]), rng.choice(["negative", "NEGATIVE", "x"])) for i in range(80)]
    names = [(f"C{i}", f"N{i}") for i in range(9)]
    t = type("Tables", (), {})()
    t.work = store
    t.fact_order = spark.createDataFrame(orders, "order_key string, order_status string, customer_key string, quantity long, g string, v string").selectExpr(
        "*", "cast(g as decimal(18,4)) gross_order_amount", "cast(v as decimal(38,4)) order_amount_variance", "order_key product_key")
    t.fact_payment = spark.createDataFrame(pays, "payment_key string, order_key string, payment_status string, a string").selectExpr("*", "cast(a as decimal(18,4)) payment_amount")
    t.fact_customer_issue = spark.createDataFrame(tickets, "ticket_id string, customer_key string, issue_category string, sentiment string")
    t.dim_customer = spark.createDataFrame(names, "customer_key string, full_name string")
    t.order_payments = store("pairs", references.payments_of_orders(t.fact_order, t.fact_payment))
    for name in ("fact_order", "fact_payment", "fact_customer_issue", "dim_customer"):
        getattr(t, name).createOrReplaceTempView(name)
    bad = "o.quantity <= 0 and lower(o.order_status) = 'completed'"
    pay = "lower(p.payment_status) = 'settled' and abs(p.payment_amount - o.gross_order_amount) > 0.01"
    none = "p.payment_key is null and lower(o.order_status) = 'completed'"
    want = spark.sql(f"""
        select i.ticket_id, i.customer_key, coalesce(c.full_name, 'Unknown'), i.issue_category, count(distinct o.order_key),
          count_if(abs(o.order_amount_variance) > 0.01), count_if({none}), count_if({pay}), count_if({bad})
        from fact_customer_issue i left join dim_customer c on i.customer_key = c.customer_key
          left join fact_order o on o.customer_key = i.customer_key left join fact_payment p on p.order_key = o.order_key
        where lower(i.sentiment) = 'negative' group by 1, 2, 3, 4""")
    assert Counter(map(tuple, answers.tickets_vs_exceptions(t).collect())) == Counter(map(tuple, want.collect()))
    flagged = spark.sql(f"""
        select o.order_key, o.customer_key is null, {none}, {pay}, {bad} from fact_order o left join fact_payment p on o.order_key = p.order_key
        where o.customer_key is null or o.product_key is null or {bad} or abs(o.order_amount_variance) > 0.01 or {none} or ({pay})""")
    yes = lambda x: "Yes" if x else "No"
    got = answers.problem_orders(t).select("order_key", "invalid_customer", "missing_payment", "payment_mismatch", "suspicious_qty")
    assert Counter(map(tuple, got.collect())) == Counter((r[0], *map(yes, r[1:])) for r in flagged.collect())
