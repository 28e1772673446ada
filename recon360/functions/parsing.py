"""Text to date, money, integer and flag; anything unreadable becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recon360.functions.text import BLANKS, strip
from recon360.model import AMOUNT

# The accepted date shapes.
#   Y-m-d   alone, with " H:M", " H:M:S", "TH:M:S" or "TH:M:SZ"
#   Y/m/d   alone or with " H:M"
#   m/d/Y   alone or with " H:M"
#   m-d-Y   alone or with " H:M"
# One or two digits for everything but the year; a one-digit day may be padded with a blank.
_BLANK = f"[{BLANKS}]"
_YEAR = r"(?!0000)(\d{4})"
_MONTH = r"(\d{1,2})"
_DAY = r"(?: (?=[1-9](?!\d)))?(\d{1,2})"
_HM = r"(?:2[0-3]|[01]?\d):[0-5]?\d"
_S = r":[0-5]?\d"
_DATE_SHAPES = (
    rf"(?s)^{_BLANK}*(?:"
    rf"{_YEAR}-{_MONTH}-{_DAY}(?:{_BLANK}+{_HM}(?:{_S})?|[Tt]{_HM}{_S}[Zz]?)?"
    rf"|{_YEAR}/{_MONTH}/{_DAY}(?:{_BLANK}+{_HM})?"
    rf"|{_MONTH}([-/]){_DAY}\8{_YEAR}(?:{_BLANK}+{_HM})?"
    rf"){_BLANK}*$|^.*$"
)
_TO_YMD = "$1$4$10-$2$5$7-$3$6$9"

# Casts trim ASCII blanks by themselves; the other blanks become spaces first.
_WIDE_BLANKS = "".join(b for b in BLANKS if ord(b) > 127)

# Spellings of the active flag; all else counts as active.
ACTIVE = ["1", "Y", "YES", "TRUE"]
INACTIVE = ["0", "N", "NO", "FALSE"]


def parse_date(c: Column) -> Column:
    """One regular expression turns every accepted shape into Y-m-d; the cast rejects bad days."""
    return F.regexp_replace(c, _DATE_SHAPES, _TO_YMD).try_cast("date")


def parse_money(c: Column) -> Column:
    """An amount to six decimals. Text that is a number but too large for the type is an error."""
    text = F.translate(c, _WIDE_BLANKS + "$,", " " * len(_WIDE_BLANKS))
    amount, number = text.try_cast(AMOUNT), text.try_cast("double")
    too_large = amount.isNull() & (F.abs(number) >= 1e18) & (F.abs(number) < float("inf"))
    return F.when(too_large, F.raise_error(F.concat(F.lit("amount out of range: "), c)).cast(AMOUNT)).otherwise(amount)


def parse_quantity(c: Column) -> Column:
    return F.translate(c, _WIDE_BLANKS, " " * len(_WIDE_BLANKS)).try_cast("bigint")


def decode_active_flag(c: Column) -> Column:
    flag = F.upper(strip(c))
    return F.when(flag.isin(ACTIVE), 1).when(flag.isin(INACTIVE), 0).otherwise(1)
