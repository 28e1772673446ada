"""Text normalisation and match keys."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank when trimming.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spellings of the one standard country.
STANDARD_COUNTRY = "USA"
COUNTRY_SPELLINGS = ["USA", "US", "UNITED STATES"]
NON_STANDARD_COUNTRIES = ["us", "united states"]

# US state names and their postal codes.
STATE_CODES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA",
    "colorado": "CO", "connecticut": "CT", "delaware": "DE", "florida": "FL", "georgia": "GA",
    "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA",
    "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD",
    "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS", "missouri": "MO",
    "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ",
    "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH",
    "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC",
    "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT",
    "virginia": "VA", "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
}


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_country(c: Column) -> Column:
    return F.when(F.upper(strip(c)).isin(COUNTRY_SPELLINGS), STANDARD_COUNTRY).otherwise(strip(c))


def normalize_state(c: Column) -> Column:
    """Full names become codes, short values upper case, everything else stays."""
    codes = F.create_map(*[F.lit(x) for x in chain.from_iterable(STATE_CODES.items())])
    value = strip(c)
    return F.when(F.length(value) <= 2, F.upper(value)).otherwise(
        F.coalesce(F.element_at(codes, F.lower(value)), value)
    )


def is_full_state_name(c: Column) -> Column:
    return F.lower(strip(c)).isin(list(STATE_CODES))


def is_country_variant(c: Column) -> Column:
    return F.lower(strip(c)).isin(NON_STANDARD_COUNTRIES)


def full_name(first: Column, last: Column) -> Column:
    part = lambda c: F.coalesce(strip(c), F.lit(""))
    return strip(F.concat(part(first), F.lit(" "), part(last)))


def clean_email(c: Column) -> Column:
    return blank_to_null(F.lower(strip(c)))


def clean_phone(c: Column) -> Column:
    return blank_to_null(c)


def match_name(first: Column, last: Column) -> Column:
    part = lambda c: F.lower(F.coalesce(strip(c), F.lit("")))
    return F.concat(part(first), F.lit(" "), part(last))


def match_phone(c: Column) -> Column:
    return blank_to_null(strip(c))


def completeness(columns: Iterable[str]) -> Column:
    """Number of columns that hold something; a blank-only text counts as filled."""
    filled = [F.when(F.col(c) != "", 1).otherwise(0) for c in columns]
    return sum(filled[1:], filled[0])


def status_is(c: Column, value: str) -> Column:
    return F.lower(c) == value
