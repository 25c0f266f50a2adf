"""Format-preserving pseudonyms by keyed Feistel networks, in native expressions only.

Candidates are found by constant patterns, validated by their kind's own rule (check digits, calendar, octets, area codes)
and mapped by a permutation of all valid values of that kind: a value keeps its format and separators, stays valid, and
gets the same pseudonym wherever it stands. What fails validation is left as it is.

Two passes put marks around what they replace. The first takes the kinds with a shape of their own. The second takes cards and
IBANs from the stretches of digits and capitals left, where more digits or capitals may stand on both sides: a stretch is
cut in groups, and of every group the number of groups that make the longest valid value from there is found, at most 34
groups on. The leftmost values are taken. Both passes take time in proportion to the text.

A value is an array of positions, each with its own radix. In every round one half is shifted, position by position and
modulo its radix, by a keyed hash of the other half, which is a bijection for any radices.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import fresh

ROUNDS = 8
#: Months from 1900 to 2099, the days 13 to 31 of them all, and two radices whose product is just above.
MONTHS, LATE, LATE_RADICES = 2400, 44_249, (211, 210)
DAYS = 73_049
_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: What follows _EDGE.
_SHAPES = {
    "email": r"(?<![._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}" + _END,
    "hex": r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)" + _END,
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9A-Za-z]|[./-][0-9])",
    "ip": r"(?<![.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "phone": r"(?<![+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})" + _END,
    "card": r"[0-9](?:[ -]?[0-9]){12,18}" + _END,
}
PATTERNS = {kind: _EDGE + shape for kind, shape in _SHAPES.items()}
#: Characters of an IBAN by country, as registered; of other countries any number may do.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
KINDS = tuple(PATTERNS)
#: Nothing outside of FOUND changes: a value, or the stretch around what looks like a card or IBAN, whose ends no value crosses.
_WITHIN = "[0-9A-Za-z@._%+()/ -]"
FOUND = "|".join([rf"(?<!{_WITHIN})(?={_WITHIN}*?(?:{PATTERNS['card']}|{PATTERNS['iban']})){_WITHIN}++", *PATTERNS.values()])


#: Around a replaced value stand a mark of its kind and a closing one. A text that has such characters is escaped first.
OPEN = "".join(chr(0xFDD0 + k) for k in range(len(KINDS)))
CLOSE, ESCAPE = chr(0xFDD0 + len(KINDS)), chr(0xFDD1 + len(KINDS))
_SAFE = "!#$&'()*,;"
_NUMBERS = "(?=[0-9(+])(?:" + "|".join(_SHAPES[kind] for kind in ("date", "ip", "ssn", "phone"))
_OTHERS = f"{_EDGE}(?:{_SHAPES['email']}|{_SHAPES['hex']}|{_NUMBERS}))"
#: What texts without candidates, nearly all, don't have; one look back keeps it out of the middle of words.
_ANY = f"{_EDGE}(?:{_NUMBERS}|{_SHAPES['card']})|{_SHAPES['iban']}|{_SHAPES['hex']})"
#: What is replaced already, with what touches it, or a stretch with what makes its first or last group invalid.
_STRETCH = f"[{OPEN}][^{CLOSE}]*+{CLOSE}[0-9A-Za-z]*+|[a-z]?[0-9A-Z -]{{13,}}+(?:[a-z@][0-9A-Za-z]*+)?"
#: Groups of a card and of an IBAN at most, and the marks of a group where one of so many groups begins.
CARD_GROUPS, IBAN_GROUPS = 19, 34
_CARD_AT, _IBAN_AT = "".join(chr(0x101 + k) for k in range(CARD_GROUPS)), "".join(chr(0x201 + k) for k in range(IBAN_GROUPS))
_AT = f"[{_CARD_AT}{_IBAN_AT}]?"
_WINDOWS = "|".join([rf"{c}[0-9]++(?:[ -]{_AT}[0-9]++){{{k}}}" for k, c in enumerate(_CARD_AT)] + [rf"{c}[0-9A-Z]++(?: {_AT}[0-9A-Z]++){{{k}}}" for k, c in enumerate(_IBAN_AT)])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(values: Column, radices: Column, tweak: Column, key: str) -> Column:
    """A permutation of the arrays whose k-th element is from 0 to radices[k] - 1."""
    half = F.floor(F.size(values) / 2).cast("int")
    cut = lambda x: (F.slice(x, F.lit(1), half), F.slice(x, half + 1, F.size(x) - half))
    (left, right), (left_radix, right_radix) = cut(values), cut(radices)

    def shifted(part: Column, radix: Column, other: Column, turn: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), i.cast("string"), F.array_join(F.transform(other, lambda o: o.cast("string")), ",")), 256)
            return F.pmod(x + F.conv(F.substr(digest, F.lit(1), F.lit(12)), 16, 10).cast("long"), F.get(radix, i)).cast("int")

        return F.transform(part, one)

    def turn(state: Column, k: Column) -> Column:
        return F.when(k % 2 == 0, F.struct(shifted(state["l"], left_radix, state["r"], k).alias("l"), state["r"].alias("r"))).otherwise(F.struct(state["l"].alias("l"), shifted(state["r"], right_radix, state["l"], k).alias("r")))

    start = F.struct(left.cast("array<int>").alias("l"), right.cast("array<int>").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits(text: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(text, "[^0-9]", "")), lambda c: c.cast("int"))


def _same(value: int, like: Column) -> Column:
    return F.transform(like, lambda _: F.lit(value))


def _refill(shape: Column, marks: str, filling: Column) -> Column:
    """shape with the k-th character that matches marks replaced by filling[k], a string."""
    return F.array_join(F.transform(_chars(shape), lambda c, i: F.when(c.rlike(marks), F.get(filling, F.length(F.regexp_replace(F.substr(shape, F.lit(1), i), f"(?!{marks}).", "")))).otherwise(c)), "")


def luhn(digits: Column) -> Column:
    """The sum over all digits, every second from the right but one doubled, modulo 10: 0 for a valid number."""
    n = F.size(digits)
    doubled = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    return F.aggregate(F.transform(digits, lambda x, i: F.when((n - i) % 2 == 0, doubled(x)).otherwise(x)), F.lit(0), lambda a, b: a + b) % 10


def _letters(text: Column, key: str, kind: str) -> Column:
    """ASCII letters and digits permuted, each within its class."""
    code = F.transform(_chars(F.regexp_replace(text, "[^0-9A-Za-z]", "")), lambda c: F.ascii(c))
    low = lambda x: F.when(x < 58, 48).when(x < 91, 65).otherwise(97)

    def filled(codes: Column) -> Column:
        new = feistel(F.transform(codes, lambda x: x - low(x)), F.transform(codes, lambda x: F.when(x < 58, 10).otherwise(26)), F.concat(F.lit(kind), F.array_join(F.transform(codes, lambda x: low(x).cast("string")), "")), key)
        return _let(F.transform(new, lambda x, i: F.char(x + low(F.get(codes, i)))), lambda chars: _refill(text, "[0-9A-Za-z]", chars))

    return _let(code, filled)


def _email(m: Column, key: str) -> Column:
    top = F.regexp_extract(m, r"\.[A-Za-z]+$", 0)
    return F.concat(_let(F.substr(m, F.lit(1), F.length(m) - F.length(top)), lambda x: _letters(x, key, "email")), top)


def _hex(m: Column, key: str) -> Column:
    new = _let(F.transform(_chars(m), lambda c: F.conv(c, 16, 10).cast("int")), lambda v: feistel(v, _same(16, v), F.lit("hex"), key))
    text = F.array_join(F.transform(new, lambda x: F.lower(F.hex(x))), "")
    return F.when(m.rlike("[A-F]"), F.upper(text)).otherwise(text)


def _card(m: Column, key: str) -> Column:
    def filled(digits: Column) -> Column:
        front = _let(F.slice(digits, F.lit(1), F.size(digits) - 1), lambda v: feistel(v, _same(10, v), F.lit("card"), key))
        return _let(front, lambda v: _let(F.concat(v, F.array((10 - luhn(F.concat(v, F.array(F.lit(0))))) % 10)), lambda x: _refill(m, "[0-9]", x.cast("array<string>"))))

    return _let(_digits(m), filled)


def _phone(m: Column, key: str) -> Column:
    """The country code stays."""
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])|^\+[0-9]", 0)
    rest = F.substr(m, F.length(code) + 1, F.length(m))
    return F.concat(code, _let(rest, lambda r: _let(_digits(r), lambda d: _refill(r, "[0-9]", feistel(d, _same(10, d), F.lit("phone"), key).cast("array<string>")))))


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    return _let(octets, lambda v: F.when(F.forall(v, lambda x: x < 256), F.array_join(feistel(v, _same(256, v), F.lit("ip"), key).cast("array<string>"), ".")).otherwise(m))


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""

    def filled(v: Column) -> Column:
        area, group, serial = (F.get(v, k) for k in range(3))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        packed = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)
        new = feistel(packed, F.array(F.lit(898), F.lit(99), F.lit(9999)), F.lit("ssn"), key)
        text = _let(new, lambda x: F.concat_ws("-", F.lpad((F.get(x, 0) + F.when(F.get(x, 0) >= 665, 2).otherwise(1)).cast("string"), 3, "0"), F.lpad((F.get(x, 1) + 1).cast("string"), 2, "0"), F.lpad((F.get(x, 2) + 1).cast("string"), 4, "0")))
        return F.when(valid, text).otherwise(m)

    return _let(F.transform(F.split(m, "-"), lambda x: x.cast("int")), filled)


def _date(m: Column, key: str) -> Column:
    """Calendar dates of 1900 to 2099, all formats linked; others are left as they are.

    Whether 03/04/2020 is in March or April can't be told: with dots or a first number over 12 the day comes first, else
    the month. Days up to 12 and later ones are permuted apart, so that a date with slashes keeps its reading, and no two
    texts of one format get the same pseudonym.
    """
    iso = m.rlike("^[0-9]{4}-")
    day_first = m.contains(".") | (F.substr(m, F.lit(1), F.lit(2)) > "12")
    part = lambda at, n: F.substr(m, F.lit(at), F.lit(n))
    text = F.when(iso, m).when(day_first, F.concat_ws("-", part(7, 4), part(4, 2), part(1, 2))).otherwise(F.concat_ws("-", part(7, 4), part(1, 2), part(4, 2)))

    def shown(day: Column) -> Column:
        slashed = F.when(F.substr(m, F.lit(1), F.lit(2)) > "12", F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "MM/dd/yyyy"))
        return F.when(iso, F.date_format(day, "yyyy-MM-dd")).when(m.contains("."), F.date_format(day, "dd.MM.yyyy")).otherwise(slashed)

    def moved(day: Column) -> Column:
        month = (F.year(day) - 1900) * 12 + F.month(day) - 1
        new = F.when(F.day(day) <= 12, _early(month, F.day(day) - 1, key)).otherwise(_let(_late(_late_rank(month) + F.day(day) - 13, key), _late_day))
        return _let(new, shown)

    return _let(F.try_to_date(text, "yyyy-MM-dd"), lambda day: F.when(F.year(day).between(1900, 2099), moved(day)).otherwise(m))


def _first_of(month: Column) -> Column:
    return F.add_months(F.lit("1900-01-01").cast("date"), month)


def _early(month: Column, day: Column, key: str) -> Column:
    new = feistel(F.array(month, day), F.array(F.lit(MONTHS), F.lit(12)), F.lit("date to 12"), key)
    return _let(new, lambda v: F.date_add(_first_of(F.get(v, 0)), F.get(v, 1)))


def _late_rank(month: Column) -> Column:
    """How many days from 13 on there are in earlier months."""
    return F.datediff(_first_of(month), F.lit("1900-01-01").cast("date")) - 12 * month


def _late(rank: Column, key: str) -> Column:
    """The permuted rank; one outside of the range is permuted again, of which there are 61, so within as many steps it is back."""
    base, excess = LATE_RADICES[1], LATE_RADICES[0] * LATE_RADICES[1] - LATE
    index = lambda v: F.get(v, 0) * base + F.get(v, 1)
    again = lambda v: feistel(v, F.array(*(F.lit(r) for r in LATE_RADICES)), F.lit("date from 13"), key)
    start = _let(rank, lambda n: F.array(F.floor(n / base).cast("int"), n % base))
    return F.aggregate(F.sequence(F.lit(1), F.lit(excess)), again(start), lambda v, _: F.when(index(v) < LATE, v).otherwise(again(v)), index)


def _late_day(rank: Column) -> Column:
    """The month is the last one whose rank isn't above; months of 28 to 31 days never stray further than one from the mean."""
    near = F.floor(rank * MONTHS / LATE).cast("int")
    month = F.when((near + 1 < MONTHS) & (_late_rank(near + 1) <= rank), near + 1).when(_late_rank(near) <= rank, near).otherwise(near - 1)
    return _let(month, lambda k: F.date_add(_first_of(k), rank - _late_rank(k) + 12))


def _mod97(text: Column) -> Column:
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.transform(_chars(text), value), F.lit(0), lambda s, x: F.when(x > 9, s * 100 + x).otherwise(s * 10 + x) % 97)


def _iban_length(country: Column) -> Column:
    """Null for a country that isn't listed."""
    return F.coalesce(*(F.when(country.isin(*names.split()), F.lit(n)) for n, names in IBAN_LENGTHS.items()))


def _iban_valid(tight: Column) -> Column:
    return _mod97(F.concat(F.substr(tight, F.lit(5), F.length(tight)), F.substr(tight, F.lit(1), F.lit(4)))) == 1


def _iban(m: Column, key: str) -> Column:
    def filled(tight: Column) -> Column:
        own = _let(F.substr(tight, F.lit(5), F.length(tight)), lambda x: _letters(x, key, "iban"))
        country = F.substr(tight, F.lit(1), F.lit(2))
        new = _let(own, lambda x: F.concat(country, F.lpad((98 - _mod97(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0"), x))
        return _let(new, lambda x: _refill(m, "[0-9A-Z]", _chars(x)))

    return _let(F.replace(m, F.lit(" "), F.lit("")), filled)


_SHAPED = {"email": _email, "hex": _hex, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone}


def _marked(kind: str, text: Column) -> Column:
    return F.concat(F.lit(OPEN[KINDS.index(kind)]), text, F.lit(CLOSE))


def _shaped(m: Column, key: str) -> Column:
    """The pseudonym of a match of _OTHERS between marks, or the match if it fails validation."""
    out = m
    for kind in reversed(_SHAPED):
        out = F.when(m.rlike(rf"\A(?:{PATTERNS[kind]})\z"), _let(_SHAPED[kind](m, key), _if_new(m, kind))).otherwise(out)
    return out


def _if_new(m: Column, kind: str) -> Callable[[Column], Column]:
    return lambda x: F.when(x != m, _marked(kind, x)).otherwise(m)


def _longest(groups: Column, member: str, most: int, valid: Callable[[Column], Column]) -> Column:
    """How many of the groups, from the first on, make the longest valid value; 0 if none do. Groups after the first have their separator."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(0).alias("best"), F.lit(True).alias("open"))

    def step(s: Column, group: Column) -> Column:
        text = F.concat(s["text"], F.regexp_replace(group, "^[ -]", ""))
        open_ = s["open"] & group.rlike(member) & (F.length(text) <= most)
        return _let(F.struct(text.alias("text"), open_.alias("open")), lambda t: F.when(t["open"], F.struct(t["text"].alias("text"), (s["n"] + 1).alias("n"), F.when(valid(t["text"]), s["n"] + 1).otherwise(s["best"]).alias("best"), F.lit(True).alias("open"))).otherwise(F.struct(s["text"].alias("text"), s["n"].alias("n"), s["best"].alias("best"), F.lit(False).alias("open"))))

    return F.aggregate(groups, start, step, lambda s: s["best"])


def _card_valid(text: Column) -> Column:
    return F.when(F.length(text) >= 13, _let(_digits(text), lambda d: luhn(d) == 0)).otherwise(False)


def _values(stretch: Column, key: str) -> Column:
    """A stretch with its cards and IBANs replaced and between marks."""

    def mark(group: Column, groups: Column, at: Column) -> Column:
        first, rest = F.regexp_replace(group, "^[ -]", ""), lambda n: F.slice(groups, at + 2, n - 1)
        card = _longest(F.concat(F.array(first), rest(CARD_GROUPS)), "^[ -]?[0-9]+$", 19, _card_valid)
        fits = lambda t, n: F.when(F.coalesce(F.length(t) == n, F.length(t) >= 15), _iban_valid(t)).otherwise(False)
        iban = _let(_iban_length(F.substr(first, F.lit(1), F.lit(2))), lambda n: _longest(F.concat(F.array(first), rest(IBAN_GROUPS)), "^ ?[0-9A-Z]+$", 34, lambda t: fits(t, n)))
        found = F.when(first.rlike("^[0-9]{1,19}$"), _let(card, lambda n: F.substr(F.lit(" " + _CARD_AT), n + 1, F.lit(1))))
        found = found.when(first.rlike("^[A-Z]{2}[0-9]{2}[0-9A-Z]*$"), _let(iban, lambda n: F.substr(F.lit(" " + _IBAN_AT), n + 1, F.lit(1))))
        return F.when(found.isNotNull() & (found != " "), F.concat(F.regexp_extract(group, "^[ -]?", 0), found, first)).otherwise(group)

    def pseudonym(m: Column) -> Column:
        bare = F.translate(m, _CARD_AT + _IBAN_AT, "")
        return F.when(m.rlike(f"^[{_CARD_AT}]"), _let(bare, lambda x: _marked("card", _card(x, key)))).otherwise(_let(bare, lambda x: _marked("iban", _iban(x, key))))

    groups = F.split(stretch, "(?=[ -])", -1)
    marked = _let(groups, lambda g: F.array_join(F.transform(g, lambda x, i: mark(x, g, i)), ""))
    return _let(marked, lambda t: F.translate(_replace(t, _WINDOWS, pseudonym), _CARD_AT + _IBAN_AT, ""))


def _replace(text: Column, pattern: str, body: Callable[[Column], Column]) -> Column:
    """text with body(match) for every match of the pattern."""

    def joined(found: Column) -> Column:
        new = F.transform(found, body)
        return F.when(F.size(found) == 0, text).otherwise(_let(new, lambda n: F.array_join(F.transform(F.split(text, pattern, -1), lambda x, i: F.concat(x, F.coalesce(F.get(n, i), F.lit("")))), "")))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), joined)


def _escaped(text: Column, back: bool = False) -> Column:
    """text without characters of our own, or such a text as it was."""
    pairs = [(ESCAPE, ESCAPE + _SAFE[-1]), *((c, ESCAPE + _SAFE[k]) for k, c in enumerate(OPEN + CLOSE))]
    for plain, safe in reversed(pairs) if back else pairs:
        text = F.replace(text, F.lit(safe if back else plain), F.lit(plain if back else safe))
    return text


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str | None = "pii_kinds") -> DataFrame:
    """docs with pseudonyms in the text, and in found_col the kinds replaced, in text order; without it if None.

    A null text stays null, with no kinds, and an empty one empty. Equal values get equal pseudonyms in all rows, whatever
    their id. Dates outside of 1900 to 2099 stay. A column of docs named found_col is replaced, others are kept. The key
    shows in query plans: take one for pseudonyms only, and rotate it. Rows don't depend on each other, so nothing is shuffled.
    """
    text = F.col(text_col)
    candidate = f"{PATTERNS['card']}|{PATTERNS['iban']}"
    odd = text.rlike(f"[{OPEN}{CLOSE}{ESCAPE}]")
    safe = F.when(odd, _escaped(text)).otherwise(text)
    shaped = _let(safe, lambda t: _replace(t, _OTHERS, lambda m: _shaped(m, key)))
    inside = lambda m: F.when(m.rlike(f"^[{OPEN}]") | ~m.rlike(candidate), m).otherwise(_values(m, key))
    done = _let(shaped, lambda t: _replace(t, _STRETCH, inside))
    names = F.array(*(F.lit(k) for k in KINDS))

    def result(t: Column) -> Column:
        kinds = F.transform(F.regexp_extract_all(t, F.lit(f"[{OPEN}]"), F.lit(0)), lambda o: F.get(names, F.instr(F.lit(OPEN), o) - 1))
        bare = F.regexp_replace(t, f"[{OPEN}{CLOSE}]", "")
        return F.struct(F.when(odd, _escaped(bare, back=True)).otherwise(bare).alias("text"), kinds.alias("kinds"))

    none = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    own = fresh(docs, "_pii")
    made = docs.withColumn(own, F.when(text.rlike(_ANY) | text.contains("@") & text.rlike(PATTERNS["email"]), _let(done, result)).otherwise(none)).withColumn(text_col, F.col(f"{own}.text"))
    if found_col:
        made = made.withColumn(found_col, F.col(f"{own}.kinds"))
    return made.drop(own)
