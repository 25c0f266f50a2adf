from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidemark.functions import normalize as n


def outcomes(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [(r.o.value, r.o.error) for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_numbers(spark):
    german = n.NumberProfile(",", ".", ("€", "zł"), "parentheses", True, ("-1", "brak"))
    got = outcomes(spark, ["1.234,50", "(5)", "(5", "12,5 %", "€ 3", "-1", "brak", None, "", "1_000", "nan", "Infinity", "7,-", "1.2E+3"], lambda c: n.decimal(c, german))
    bad = (None, "invalid-numeric-value")
    assert got == [("1234.5", None), ("-5", None), bad, ("0.125", None), ("3", None), (None, None), (None, None), (None, None), bad, bad, bad, bad, bad, ("12000", None)]
    guarded = n.NumberProfile(reject_scientific=True, fixed_width=3)
    assert [e for _, e in outcomes(spark, ["1.2E+14", "12", "123", "x23"], lambda c: n.decimal(c, guarded))] == ["scientific-notation-identifier-unrecoverable", "fixed-width-identifier-below-declared-width", None, "invalid-numeric-value"]
    with pytest.raises(ValueError):
        n.NumberProfile(",", ",")


def test_numbers_are_exact(spark):
    from decimal import Decimal, localcontext

    import random

    r = random.Random(1)
    texts = ["0.123456789", "1e-7", "1E+20", "-0", "-0.00", "+5", ".5", "5.", ".", "e5", "9" * 50 + ".25", "1e999", "1e-999", "1e1000", "00012.3400", "-1.5E-3", "12E0003"]
    texts += [f"{r.choice(['', '-', '+'])}{r.randint(0, 10**r.randint(0, 45))}{r.choice(['', '.'])}{r.randint(0, 10**r.randint(0, 30))}{r.choice(['', '', f'E{r.randint(-60, 60)}'])}" for _ in range(300)]

    def want(text, shift):
        with localcontext() as ctx:
            ctx.prec = 5000
            try:
                v = Decimal(text).scaleb(shift)
            except ArithmeticError:
                return None, "invalid-numeric-value"
            if abs(int(text.lower().partition("e")[2] or 0)) > 999:
                return None, "invalid-numeric-value"
            shown = format(v, "f")
            shown = shown.rstrip("0").rstrip(".") if "." in shown else shown
            return "0" if shown in ("-0", "0") else shown, None

    assert outcomes(spark, texts, n.decimal) == [want(t, 0) for t in texts]
    percent = n.NumberProfile(percent_as_fraction=True)
    assert outcomes(spark, [f"{t} %" for t in texts], lambda c: n.decimal(c, percent)) == [want(t, -2) for t in texts]


def test_casts_have_errors(spark):
    cast = lambda kind, *values: outcomes(spark, values, lambda c: n.typed(c, kind))
    assert cast("integer", "5", "5.0", "x", None)[::2] == [(5, None), (None, "not-castable-to-integer")] and cast("integer", None) == [(None, None)]
    assert cast("decimal", "1." + "1" * 18, "1." + "1" * 19)[1] == (None, "not-castable-to-decimal")
    assert cast("date", "2024-02-30") == [(None, "not-castable-to-date")] and cast("boolean", "True")[0][0] is True


def test_dates(spark):
    assert outcomes(spark, ["2024-1-3", "2024-02-30", None, "x", "2024-12-31 "], n.date) == [("2024-01-03", None), (None, "invalid-calendar-date"), (None, None), (None, "invalid-calendar-date"), (None, "invalid-calendar-date")]
    assert outcomes(spark, ["01-02-30", "01-02-31", "29-02-00"], lambda c: n.date(c, "%d-%m-%y", 30)) == [("2030-02-01", None), ("1931-02-01", None), ("2000-02-29", None)]
    assert outcomes(spark, ["2024-05-01T10:00:00+02:00", "2024-05-01T10:00:00Z", "2024-05-01T10:00:00+0530"], lambda c: n.date(c, "%Y-%m-%dT%H:%M:%S%z")) == [("2024-05-01T08:00:00+00:00", None), ("2024-05-01T10:00:00+00:00", None), ("2024-05-01T04:30:00+00:00", None)]
    assert outcomes(spark, ["2024-05-01 10:00"], lambda c: n.date(c, "%Y-%m-%d %H:%M")) == [(None, "naive-timestamp-without-a-declared-zone")]
    assert outcomes(spark, ["59", "60", "61", "x", "-3", None], n.serial_date) == [("1900-02-28", None), (None, "spreadsheet-serial-date-does-not-exist"), ("1900-03-01", None), (None, "invalid-calendar-date"), ("1899-12-28", None), (None, None)]


@pytest.mark.parametrize("zone", ["Europe/Warsaw", "America/New_York", "Australia/Lord_Howe", "Asia/Kolkata"])
def test_wall_times(spark, zone):
    z, walls = ZoneInfo(zone), []
    for start in ("2026-03-07", "2026-03-28", "2026-04-04", "2026-10-03", "2026-10-24", "2026-10-31"):
        walls += [datetime.fromisoformat(start) + timedelta(minutes=20 * k) for k in range(150)]
    want = {"reject": [], "earliest": [], "latest": []}
    for w in walls:
        early, late = (w.replace(tzinfo=z, fold=f).astimezone(UTC) for f in (0, 1))
        gap, twice = early.astimezone(z).replace(tzinfo=None) != w, early != late
        for policy, out in want.items():
            if gap:
                out.append((None, "nonexistent-local-time"))
            elif twice and policy == "reject":
                out.append((None, "ambiguous-local-time-requires-a-declared-fold-policy"))
            else:
                out.append(((late if twice and policy == "latest" else early).isoformat(), None))
    for policy, out in want.items():
        assert outcomes(spark, [w.isoformat() for w in walls], lambda c, p=policy: n.local_timestamp(c, "%Y-%m-%dT%H:%M:%S", zone, p)) == out


def test_texts(spark):
    df = spark.createDataFrame([("é", "a\0b", None), (None, "", "x")], "a string, b string, c string")
    rows = df.select(n.nfc(F.col("a")).alias("a"), n.strip_nul(F.col("b")).alias("b"), n.raw_line(F.col("b"), F.col("c")).alias("l"), n.record_hash(F.col("c"), F.lit("")).alias("h")).collect()
    assert rows[0].a == "é" and rows[0].b == "ab" and rows[1].l == ",x" and rows[0].h != rows[1].h
    same = spark.sql("SELECT array('a', 'b') f").select(n.ragged(F.col("f"), 3).alias("e"), n.ragged(F.col("f"), 2).alias("g")).first()
    assert (same.e, same.g) == ("RAGGED_ROW", None)
    assert outcomes(spark, ["Tak", "tak", None], lambda c: n.boolean(c, ["Tak"], ["Nie"])) == [("True", None), (None, "unmapped-boolean-token"), (None, None)]
