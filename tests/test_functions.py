import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recon360.functions import messages, parsing, text

# The accepted date formats.
FORMATS = [
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M", "%m/%d/%Y %H:%M",
    "%Y/%m/%d %H:%M", "%m-%d-%Y %H:%M", "%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%m-%d-%Y",
]


def expected_date(value):
    def attempt(fmt):
        try:
            return datetime.strptime(value.strip(), fmt).date()
        except ValueError:
            return None

    return next((d for d in map(attempt, FORMATS) if d), None) if value else None


def evaluate(spark, values, expression, type_="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {type_}")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_dates_known_cases(spark):
    cases = [
        "2025-03-01 10:15:00", "2025-03-01T10:15:00Z", "2025-03-01T10:15:00", "2025-03-01 10:15", "03/02/2025 14:20",
        "2025/03/03 09:00", "05-06-2025 16:30", "2025-03-01", "3/2/2025", "2025/3/3", "5-6-2025", " 2025-03-01 ",
        "2025-03-01t10:15:00z", "2025-03-01   10:15", "2025-03-01\t10:15", "1999-7- 7", "2024-02-29", " 2025-03-01",
        "", " ", None, "bad_timestamp", "2025-02-29", "2025-13-01", "31-12-2025", "2025-03-01 24:00", "2025-03-01 10:60",
        "2025-03-01 10:15:60", "2025-03-01 10:15:00.5", "2025-03-01T10:15", "2025-03-01T10:15:00+01:00", "003/02/2025",
        "-1999-12-20", "2025/03/01 10:15:00", "03-06/2025", "0000-01-01", "20250301", "2025-03", "2025", "1999-7-  7",
        "2025-03-01 10:15:00Z", "2025-03-00", "12/31/1999 23:59", "2025-03-01\n", "2025-03-0110:15",
    ]
    assert evaluate(spark, cases, parsing.parse_date) == [expected_date(v) for v in cases]


def test_dates_random_mutations(spark):
    rng = random.Random(7)
    seeds = [datetime(2025, 3, 9, 7, 5, 2), datetime(1999, 12, 31, 23, 59, 59), datetime(2024, 2, 29)]
    values = []
    for _ in range(6000):
        v = list(rng.choice(seeds).strftime(rng.choice(FORMATS)))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(v))
            change = rng.randrange(3)
            if change == 0:
                v[at] = rng.choice("0123456789-/: TtZz")
            elif change == 1 and len(v) > 1:
                del v[at]
            else:
                v.insert(at, rng.choice("0123456789-/: TtZz"))
        values.append("".join(v))
    got = evaluate(spark, values, parsing.parse_date)
    wrong = [(v, g, expected_date(v)) for v, g in zip(values, got) if g != expected_date(v)]
    assert not wrong


def test_money(spark):
    cases = {
        "36.00": "36", " $1,234.50 ": "1234.5", "$ 5.00": "5", "-21.00": "-21", ".5": "0.5", "5.": "5", "1e3": "1000",
        " 7": "7", "": None, " ": None, "abc": None, "12d": None, "1 000": None, None: None, "nan": None,
        "1.005": "1.005", "123456789012345.00": "123456789012345", "0.00004": "0.00004", "1e17": "100000000000000000",
    }
    got = evaluate(spark, list(cases), parsing.parse_money)
    assert got == [None if v is None else Decimal(v) for v in cases.values()]
    with pytest.raises(Exception, match="out of range"):  # never dropped without a word
        evaluate(spark, ["1e20"], parsing.parse_money)


def test_quantity(spark):
    cases = {" 3 ": 3, "+3": 3, "-1": -1, "0": 0, "3.0": None, "abc": None, "": None, None: None, "3000000000": 3_000_000_000}
    assert evaluate(spark, list(cases), parsing.parse_quantity) == list(cases.values())


def test_active_flag(spark):
    cases = {"Y": 1, " yes ": 1, "1": 1, "true": 1, "N": 0, "no": 0, "0": 0, " False": 0, "": 1, None: 1, "maybe": 1}
    assert evaluate(spark, list(cases), parsing.decode_active_flag) == list(cases.values())


def test_country_and_state(spark):
    countries = {"US": "USA", " united states ": "USA", "usa": "USA", " Canada ": "Canada", "": "", " ": "", None: None}
    assert evaluate(spark, list(countries), text.normalize_country) == list(countries.values())
    states = {
        "Illinois": "IL", " NEW YORK ": "NY", "ca": "CA", "TX": "TX", "x": "X", "Ontario": "Ontario", " Puerto Rico ": "Puerto Rico",
        "": "", None: None, "west virginia": "WV",
    }
    assert evaluate(spark, list(states), text.normalize_state) == list(states.values())


# The postal codes of the US states, in order of their names.
POSTAL_CODES = """
Alabama AL, Alaska AK, Arizona AZ, Arkansas AR, California CA, Colorado CO, Connecticut CT, Delaware DE, Florida FL, Georgia GA,
Hawaii HI, Idaho ID, Illinois IL, Indiana IN, Iowa IA, Kansas KS, Kentucky KY, Louisiana LA, Maine ME, Maryland MD,
Massachusetts MA, Michigan MI, Minnesota MN, Mississippi MS, Missouri MO, Montana MT, Nebraska NE, Nevada NV, New Hampshire NH,
New Jersey NJ, New Mexico NM, New York NY, North Carolina NC, North Dakota ND, Ohio OH, Oklahoma OK, Oregon OR, Pennsylvania PA,
Rhode Island RI, South Carolina SC, South Dakota SD, Tennessee TN, Texas TX, Utah UT, Vermont VT, Virginia VA, Washington WA,
West Virginia WV, Wisconsin WI, Wyoming WY
"""


def test_every_state_has_its_code(spark):
    pairs = dict(p.strip().rsplit(" ", 1) for p in POSTAL_CODES.split(","))
    assert len(pairs) == 50
    assert dict(zip(pairs, evaluate(spark, list(pairs), text.normalize_state), strict=True)) == pairs


def test_names_and_contacts(spark):
    df = spark.createDataFrame(
        [(" Ava ", "Patel\t", " A@X.com ", " 1 "), ("", "Lee", "", ""), (None, None, None, None), ("Bo", "", " ", " ")],
        "f string, l string, e string, p string",
    )
    rows = df.select(
        text.full_name(F.col("f"), F.col("l")), text.clean_email(F.col("e")), text.clean_phone(F.col("p")),
        text.match_name(F.col("f"), F.col("l")), text.match_phone(F.col("p")),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("Ava Patel", "a@x.com", " 1 ", "ava patel", "1"),
        ("Lee", None, None, " lee", None),
        ("", None, None, " ", None),
        ("Bo", None, " ", "bo ", None),
    ]


def test_completeness_counts_blank_text_as_filled(spark):
    df = spark.createDataFrame([("a", "", None), (" ", "b", "c")], "x string, y string, z string")
    assert [r[0] for r in df.select(text.completeness(["x", "y", "z"])).collect()] == [1, 3]


@pytest.mark.parametrize(
    "value,shown",
    [("50", "50.0"), ("-21", "-21.0"), ("44.25", "44.25"), ("12345678.5", "12345678.5"), ("0", "0.0"), ("0.0001", "0.0001"),
     ("10.1", "10.1"), (None, "None")],
)
def test_amounts_in_messages(spark, value, shown):
    df = spark.createDataFrame([(None if value is None else Decimal(value),)], "v decimal(18,4)")
    assert df.select(messages.shown_amount(F.col("v"))).first()[0] == shown
    if value is not None and shown != "0.0001":
        assert shown == repr(float(value))


def test_message_places(spark):
    df = spark.createDataFrame([("k", 3)], "k string, n int")
    got = df.select(messages.message("a {k}: {n}!", k=F.col("k"), n=messages.shown(F.col("n")))).first()[0]
    assert got == "a k: 3!"
