"""Value normalisers as column expressions.

Each takes the text column of one field and gives struct<value: string, error: string>: error is null for a good value, a
null value is an absent one. They are evaluated in one projection, and `first_error` keeps the order of the stages.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SCIENTIFIC = r"\A-?[0-9](\.[0-9]+)?[eE][+-]?[0-9]+\z"
#: What an exact decimal may look like after its locale is gone: no underscores, no infinities. Its parts are the sign, the
#: digits before and after the point, and the exponent; one of more than three digits would make texts of thousands of zeros.
PLAIN_NUMBER = r"\A([+-]?)(?=\.?[0-9])([0-9]*)\.?([0-9]*)(?:[eE]([+-]?0*[0-9]{1,3}))?\z"
#: One as exact() gives it.
CANONICAL_NUMBER = r"\A(?:0|-?(?:[1-9][0-9]*(?:\.[0-9]*[1-9])?|0\.[0-9]*[1-9]))\z"
TIME_DIRECTIVES = ("%H", "%I", "%M", "%S", "%f", "%z", "%Z", "%p", "%X")
#: strptime directives by the datetime pattern letters that read the same texts; one digit suffices for day and month.
DIRECTIVES = {"%Y": "yyyy", "%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s", "%y": "yy", "%b": "MMM", "%B": "MMMM", "%f": "SSSSSS", "%j": "D", "%p": "a", "%I": "h"}
OFFSET_FORMATS = "[XXX][XX][X]"


def outcome(value: Column, error: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    error = none if error is None else error
    return F.struct(F.when(error.isNull(), value).cast("string").alias("value"), error.cast("string").alias("error"))


def first_error(*results: Column) -> Column:
    """The error of the first normaliser that has one."""
    return F.coalesce(*(r["error"] for r in results))


def null_tokens(col: Column, tokens: Sequence[str] = ("",)) -> Column:
    """Exact, case-sensitive tokens become null."""
    return F.when(col.isin(*tokens), F.lit(None)).otherwise(col) if tokens else col


def boolean(col: Column, true_tokens: Sequence[str], false_tokens: Sequence[str]) -> Column:
    """Exact tokens become `True` or `False`; null passes, anything else is an error."""
    value = F.when(col.isin(*true_tokens), "True").when(col.isin(*false_tokens), "False")
    return outcome(value, F.when(col.isNotNull() & value.isNull(), "unmapped-boolean-token"))


@dataclass(frozen=True)
class NumberProfile:
    """How a column writes numbers."""

    decimal_separator: str = "."
    thousands_separator: str | None = None
    currency_symbols: tuple[str, ...] = ()
    negative_style: str = "leading-minus"
    percent_as_fraction: bool = False
    null_sentinels: tuple[str, ...] = ()
    reject_scientific: bool = False
    fixed_width: int | None = None

    def __post_init__(self) -> None:
        if self.decimal_separator == self.thousands_separator:
            raise ValueError("decimal and thousands separators must differ")
        if self.negative_style not in ("leading-minus", "parentheses", "trailing-minus"):
            raise ValueError(f"unknown negative style {self.negative_style!r}")


def clean_number(col: Column, profile: NumberProfile) -> tuple[Column, Column]:
    """The text of the number with `.` and a leading minus, and whether it was a percentage."""
    text = col
    for symbol in profile.currency_symbols:
        text = F.replace(text, F.lit(symbol), F.lit(""))
    text = F.regexp_replace(text, r"^\s+|\s+$", "")
    percent = text.endswith("%")
    text = F.when(percent, F.regexp_replace(text, r"\s*%$", "")).otherwise(text)
    if profile.negative_style == "parentheses":
        text = F.regexp_replace(text, r"^\((.*)\)$", "-$1")
    elif profile.negative_style == "trailing-minus":
        text = F.regexp_replace(text, r"^(.*)-$", "-$1")
    if profile.thousands_separator is not None:
        text = F.replace(text, F.lit(profile.thousands_separator), F.lit(""))
    return F.replace(text, F.lit(profile.decimal_separator), F.lit(".")), percent


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def exact(text: Column, shift: Column | int = 0) -> Column:
    """A number times ten to the power of shift, digit by digit and so of any length, without needless zeros; null for what is no number."""

    def shown(p: Column) -> Column:
        digits, point = F.concat(p["whole"], p["rest"]), p["point"]
        whole = F.when(point <= 0, "").otherwise(F.rpad(F.substr(digits, F.lit(1), point), point, "0"))
        rest = F.when(point < 0, F.concat(F.repeat(F.lit("0"), -point), digits)).otherwise(F.substr(digits, point + 1))
        whole, rest = F.regexp_replace(whole, "^0+", ""), F.regexp_replace(rest, "0+$", "")
        number = _let(F.struct(whole.alias("whole"), rest.alias("rest")), lambda x: F.concat(F.when(x["whole"] == "", "0").otherwise(x["whole"]), F.when(x["rest"] == "", "").otherwise(F.concat(F.lit("."), x["rest"]))))
        return _let(number, lambda x: F.when((p["sign"] == "-") & (x != "0"), F.concat(F.lit("-"), x)).otherwise(x))

    def parts(t: Column) -> Column:
        part = lambda k: F.regexp_extract(t, PLAIN_NUMBER, k)
        point = F.length(part(2)) + F.coalesce(part(4).try_cast("int"), F.lit(0)) + shift
        return F.when(t.rlike(PLAIN_NUMBER), _let(F.struct(part(1).alias("sign"), part(2).alias("whole"), part(3).alias("rest"), point.alias("point")), shown))

    # Most numbers need nothing.
    return _let(text, lambda t: F.when(t.rlike(CANONICAL_NUMBER) & ((shift if isinstance(shift, Column) else F.lit(shift)) == 0), t).otherwise(parts(t)))


def decimal(col: Column, profile: NumberProfile = NumberProfile()) -> Column:
    """Exact decimals, as text without needless zeros; sentinels first, then the guards, then the parse."""
    text, percent = clean_number(col, profile)
    absent = col.isNull() | (col.isin(*profile.null_sentinels) if profile.null_sentinels else F.lit(False))
    error = F.when(absent, F.lit(None).cast("string"))
    if profile.reject_scientific:
        error = error.when(col.rlike(SCIENTIFIC), "scientific-notation-identifier-unrecoverable")
    if profile.fixed_width is not None:
        error = error.when(F.length(col) < profile.fixed_width, "fixed-width-identifier-below-declared-width")
    shown = exact(text, F.when(percent, -2).otherwise(0) if profile.percent_as_fraction else 0)
    return _let(F.when(absent, F.lit(None)).otherwise(shown), lambda x: outcome(x, error.when(x.isNull(), "invalid-numeric-value")))


def pattern_of(strptime: str) -> str:
    """The datetime pattern that reads what a strptime format reads."""
    out, at = "", 0
    while at < len(strptime):
        two = strptime[at : at + 2]
        if two == "%z":
            out, at = out + OFFSET_FORMATS, at + 2
        elif two in DIRECTIVES:
            out, at = out + DIRECTIVES[two], at + 2
        elif two.startswith("%"):
            raise ValueError(f"format directive {two!r} isn't supported")
        else:
            out, at = out + (f"'{strptime[at]}'" if strptime[at].isalpha() else strptime[at]), at + 1
    return out


def _parsed(col: Column, strptime: str, pivot: int | None) -> Column:
    """A timestamp in the session's zone, which is UTC; an invalid text gives null. A two-digit year goes by the pivot alone."""
    stamp = F.try_to_timestamp(col, F.lit(pattern_of(strptime)))
    if "%y" not in strptime:
        return stamp
    if pivot is None:
        raise ValueError("a two-digit year needs a declared pivot")
    two = F.year(stamp) % 100
    year = F.when(two <= pivot, 2000 + two).otherwise(1900 + two)
    there = F.concat(F.lpad(year.cast("string"), 4, "0"), F.date_format(stamp, "-MM-dd HH:mm:ss.SSSSSS"))
    return F.try_to_timestamp(there, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _iso(stamp: Column) -> Column:
    fraction = F.date_format(stamp, "SSSSSS")
    return F.concat(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)), F.lit("+00:00"))


def date(col: Column, strptime: str = "%Y-%m-%d", pivot: int | None = None) -> Column:
    """ISO dates, or UTC instants if the format has an offset; a time without offset is an error."""
    timed = any(d in strptime for d in TIME_DIRECTIVES)
    stamp = _parsed(col, strptime, pivot)
    error = F.when(col.isNotNull() & stamp.isNull(), "invalid-calendar-date")
    if timed and "%z" not in strptime:
        error = error.when(col.isNotNull(), "naive-timestamp-without-a-declared-zone")
    return outcome(_iso(stamp) if timed else F.date_format(stamp, "yyyy-MM-dd"), error)


def classify_local(stamp: Column, zone: str) -> Column:
    """A wall time in a zone is `nonexistent`, `ambiguous` or `unambiguous`.

    to_utc_timestamp takes the earlier of two instants; the later one is found by the offset a day on, so that shifts
    other than an hour are seen as well.
    """
    earlier = F.to_utc_timestamp(stamp, zone)
    return F.when(F.from_utc_timestamp(earlier, zone) != stamp, "nonexistent").when((later_instant(stamp, zone) != earlier) & (F.from_utc_timestamp(later_instant(stamp, zone), zone) == stamp), "ambiguous").otherwise("unambiguous")


def later_instant(stamp: Column, zone: str) -> Column:
    """The instant under the offset that holds a day after the wall time."""
    offset = lambda t: F.from_utc_timestamp(t, zone).cast("long") - t.cast("long")
    next_day = F.to_utc_timestamp(stamp, zone) + F.expr("interval 1 day")
    return (stamp.cast("double") - offset(next_day)).cast("timestamp")


def local_timestamp(col: Column, strptime: str, zone: str, policy: str = "reject", pivot: int | None = None) -> Column:
    """UTC instants of wall times; policy for ambiguous ones: reject, earliest or latest."""
    stamp = _parsed(col, strptime, pivot)
    kind = classify_local(stamp, zone)
    error = F.when(col.isNotNull() & stamp.isNull(), "invalid-calendar-date").when(kind == "nonexistent", "nonexistent-local-time")
    if policy == "reject":
        error = error.when(kind == "ambiguous", "ambiguous-local-time-requires-a-declared-fold-policy")
    instant = F.to_utc_timestamp(stamp, zone)
    if policy == "latest":
        instant = F.when(kind == "ambiguous", later_instant(stamp, zone)).otherwise(instant)
    return outcome(_iso(instant), error)


def serial_date(col: Column, system: str = "1900") -> Column:
    """Spreadsheet serial numbers; in the 1900 system 60 is a day that never was, and earlier ones count from a day later."""
    serial = F.when(col.rlike(r"\A\s*[+-]?[0-9]{1,7}\s*\z"), F.trim(col).try_cast("int"))
    if system == "1900":
        day = F.when(serial < 60, F.date_add(F.lit("1899-12-31").cast("date"), serial)).otherwise(F.date_add(F.lit("1899-12-30").cast("date"), serial))
        missing = serial == 60
    else:
        day, missing = F.date_add(F.lit("1904-01-01").cast("date"), serial), F.lit(False)
    error = F.when(col.isNotNull() & serial.isNull(), "invalid-calendar-date").when(missing, "spreadsheet-serial-date-does-not-exist")
    return outcome(F.date_format(day, "yyyy-MM-dd"), error)


def nfc(col: Column) -> Column:
    """Canonical composition, for which Spark has no function. Of texts in ASCII, by far the most, only nulls go to Python."""

    @F.pandas_udf("string")
    def compose(texts: pd.Series) -> pd.Series:
        return texts.str.normalize("NFC")

    return F.coalesce(compose(F.when(col.rlike(r"[^\x00-\x7F]"), col)), col)


def strip_nul(col: Column) -> Column:
    return F.replace(col, F.char(F.lit(0)), F.lit(""))


def field_text(col: Column, kind: str = "string") -> Column:
    """A field as hashes see it: null is empty, booleans are `True` and `False`."""
    text = F.when(col, "True").otherwise("False") if kind == "boolean" else col.cast("string")
    return F.coalesce(F.when(col.isNotNull(), text), F.lit(""))


def record_hash(*cols: Column) -> Column:
    """SHA-256, as hexadecimal digits, of the fields joined by bars; version 1 of the hash. Null and empty are the same."""
    return F.sha2(F.concat_ws("|", *(field_text(c) for c in cols)).cast("binary"), 256)


def raw_line(*cols: Column) -> Column:
    return F.concat_ws(",", *(field_text(c) for c in cols))


def ragged(fields: Column, width: int) -> Column:
    """The error of a row whose number of fields isn't the header's; rows are neither padded nor cut."""
    return F.when(F.size(fields) != width, "RAGGED_ROW")


#: Normalisers by the name that a column's specification gives.
REGISTRY: dict[str, Callable[..., Column]] = {"boolean": boolean, "decimal": decimal, "date": date, "local_timestamp": local_timestamp, "serial_date": serial_date}


#: Types of a contract, and what a table that is published holds.
GOLD_TYPES = {"string": "string", "integer": "bigint", "decimal": "decimal(38,18)", "date": "date", "timestamp": "timestamp", "boolean": "boolean"}


def typed(col: Column, kind: str) -> Column:
    """A normalised text as its contract's type: struct<value, error>; a text that doesn't fit is an error, not a null."""
    value = col.try_cast(GOLD_TYPES[kind])
    if kind == "decimal":  # more places than the type has would be rounded
        value = _let(value, lambda v: F.when(exact(col) == exact(v.cast("string")), v))
    error = F.when(col.isNotNull() & value.isNull(), F.lit(f"not-castable-to-{kind}"))
    return F.struct(value.alias("value"), error.alias("error"))
