"""What a CSV sample says about its file: encoding, dialect, header, footer, types. Runs once per file, on the driver."""

from __future__ import annotations

import csv
import io
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from itertools import takewhile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import DIRECTIVES

SAMPLE_BYTES = 64 * 1024
#: Byte order marks, longer ones first: that of UTF-16 LE starts that of UTF-32 LE.
MARKS = ((b"\xff\xfe\x00\x00", "utf-32-le"), (b"\x00\x00\xfe\xff", "utf-32-be"), (b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
#: Candidates in order of preference.
DELIMITERS = (",", ";", "\t", "|", "^", "~", "\x1f", "\x01")
QUOTES = ('"', "'")
CODE_PAGES = ("cp1250", "cp1252", "iso-8859-2")
#: Scores that differ by less don't decide between code pages.
NEAR = 0.01
BOOLEANS = frozenset({"true", "false", "yes", "no", "0", "1"})
TELLING_BOOLEANS = frozenset({"true", "false", "yes", "no"})


class SourceError(Exception):
    """A file that can't be read as its contract says; code names why."""

    def __init__(self, code: str, detail: str = ""):
        super().__init__(f"{code}: {detail}" if detail else code)
        self.code = code


@dataclass
class Encoding:
    name: str
    confidence: float
    mark: bool = False


def detect_encoding(sample: bytes) -> Encoding:
    """A byte order mark is certain; else UTF-16 by its zeros, UTF-8 if it decodes strictly, or the likeliest single-byte code page.

    Code pages that are about as likely and read the sample differently leave it undetermined: then a contract must name one.
    """
    for mark, name in MARKS:
        if sample.startswith(mark):
            return Encoding(name, 1.0, True)
    zeros = sample.count(0) / max(1, len(sample))
    if zeros > 0.3:
        even, odd = sample[0::2].count(0), sample[1::2].count(0)
        return Encoding("utf-16-be" if even > odd else "utf-16-le", 0.99)
    try:
        sample.decode("utf-8")
        return Encoding("utf-8", 1.0 if sample.isascii() else 0.99)
    except UnicodeDecodeError as e:
        if e.start >= len(sample) - 3 and len(sample) >= SAMPLE_BYTES:  # a character cut by the end of the sample
            return Encoding("utf-8", 0.99)
    scores = {name: _likely(sample, name) for name in CODE_PAGES}
    best = max(CODE_PAGES, key=lambda name: scores[name])
    rivals = [name for name in CODE_PAGES if scores[best] - scores[name] <= NEAR and sample.decode(name, "replace") != sample.decode(best, "replace")]
    return Encoding("undetermined" if rivals or scores[best] < 0.5 else best, scores[best])


def _likely(sample: bytes, name: str) -> float:
    """How many of the non-ASCII bytes are letters under a code page."""
    try:
        text = sample.decode(name)
    except UnicodeDecodeError:
        return 0.0
    high = [c for c in text if ord(c) > 127]
    return sum(c.isalpha() for c in high) / len(high) if high else 1.0


def decode(raw: bytes, encoding: str) -> str:
    try:
        return raw.decode(encoding)
    except (UnicodeDecodeError, LookupError) as e:
        raise SourceError("undecodable-bytes", str(e)) from e


@dataclass(frozen=True)
class Dialect:
    """delimiter is empty if none can be told."""

    delimiter: str
    quote: str


def detect_dialect(text: str, delimiter: str | None = None, quote: str | None = None) -> Dialect:
    """What is declared, else the delimiter and quote whose rows agree best on a width above one.

    The second quote needs fields that start and end with it, so that an apostrophe is none.
    """
    best, found = (0.0, 0, 0), Dialect(delimiter or "", quote or QUOTES[0])
    for q in [quote] if quote else QUOTES:
        for d in [delimiter] if delimiter else DELIMITERS:
            edge = f"(?:^|$|{re.escape(d)})"
            if q != QUOTES[0] and quote is None and not re.search(rf"(?m){edge}{q}[^{q}]*{q}{edge}", text):
                continue
            widths = Counter(len(r) for r in csv.reader(io.StringIO(text), delimiter=d, quotechar=q) if r)
            if not widths:
                continue
            width, n = max(widths.items(), key=lambda x: (x[1], x[0]))
            rank = (n / sum(widths.values()), QUOTES.index(q) if q in QUOTES else 0, width)
            if (width > 1 or delimiter) and rank > best:
                best, found = rank, Dialect(d, q)
    return found


def detect_delimiter(text: str, declared: str | None = None, quote: str | None = None) -> str:
    """The declared one, else the one whose rows agree best; empty if none does."""
    return declared if declared is not None else detect_dialect(text, None, quote).delimiter


def require_delimiter(delimiter: str) -> str:
    if not delimiter:
        raise SourceError("dialect-detection-declined")
    return delimiter


def _number(value: str) -> bool:
    try:
        float(value)
    except ValueError:
        return False
    return True


@dataclass
class Header:
    index: int
    names: tuple[str, ...]
    footer: tuple[int, ...] = ()
    repeated: tuple[int, ...] = ()


def detect_header(rows: Sequence[Sequence[str]], index: int | None = None, trim: bool = True, skip_footer: int = 0, footer_patterns: Sequence[str] = (), case_sensitive: bool = False) -> Header:
    """The declared row, else the first of filled, non-numeric fields that is as wide as most rows after it.

    Trailing rows of another width, or whose first field matches a footer pattern, are the footer; rows equal to the
    header are repeated headers. Neither is removed here.
    """
    if index is None:
        for k, row in enumerate(rows):
            widths = Counter(len(r) for r in rows[k + 1 :])
            if row and all(row) and not any(map(_number, row)) and (not widths or len(row) == widths.most_common(1)[0][0]):
                index = k
                break
        else:
            raise SourceError("header-not-found")
    raw = tuple(rows[index])
    names = tuple(n.strip() for n in raw) if trim else raw
    same = Counter(n if case_sensitive else n.casefold() for n in names)
    if twice := [n for n, k in same.items() if k > 1]:
        raise SourceError("duplicate-header-names", ", ".join(twice))
    marks = re.compile("|".join(f"(?:{p})" for p in footer_patterns) or r"(?!)")
    below = list(enumerate(rows))[index + 1 :]
    odd = lambda place: len(place[1]) != len(raw) or bool(place[1]) and marks.match(place[1][0]) is not None
    footer = below[-skip_footer:] if skip_footer else list(takewhile(odd, reversed(below)))
    return Header(index, names, tuple(sorted(k for k, _ in footer)), tuple(k for k, row in below if tuple(row) == raw))


def infer_types(df: DataFrame, columns: Sequence[str], date_patterns: str | Sequence[str] = ()) -> DataFrame:
    """column_name, suggested_type and red_flag of text columns, over all their non-null values in one pass.

    Boolean, then the first date pattern that all values fit, then integer and decimal; a string wherever a value doesn't fit
    or looks damaged, with a flag for the latter.
    """
    patterns = [date_patterns] if isinstance(date_patterns, str) else list(date_patterns)
    tests: dict[str, Column] = {}
    for c in columns:
        v, low = F.col(c), F.lower(F.trim(c))
        tests |= {
            f"{c}_n": F.count(v),
            f"{c}_closed": F.every(low.isin(*BOOLEANS)),
            f"{c}_telling": F.some(low.isin(*TELLING_BOOLEANS)),
            **{f"{c}_date{i}": F.every(F.try_to_timestamp(v, F.lit(p)).isNotNull()) for i, p in enumerate(patterns)},
            f"{c}_scientific": F.some(v.rlike(r"\A-?[0-9]+(\.[0-9]+)?[eE][+-]?[0-9]+\z")),
            f"{c}_digits": F.every(v.rlike(r"\A-?[0-9]+\z")),
            f"{c}_zero": F.some(v.rlike(r"\A-?0[0-9]+\z")),
            f"{c}_decimal": F.every(v.rlike(r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z")),
            f"{c}_some_decimal": F.some(v.rlike(r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z")),
        }
    one = df.agg(*(t.alias(k) for k, t in tests.items()))
    day_or_time = ["timestamp" if re.search("[HhmsSa]", re.sub(r"'[^']*'", "", p)) else "date" for p in patterns]

    def row(c: str) -> Column:
        is_ = lambda k: F.coalesce(F.col(f"{c}_{k}"), F.lit(False))
        boolean = is_("closed") & is_("telling")
        dated = F.coalesce(*(F.when(is_(f"date{i}"), t) for i, t in enumerate(day_or_time)), F.lit(None).cast("string"))
        kind = F.when(F.col(f"{c}_n") == 0, "string").when(boolean, "boolean").when(dated.isNotNull(), dated).when(is_("scientific"), "string").when(is_("digits"), F.when(is_("zero"), "string").otherwise("integer")).when(is_("decimal"), "decimal").otherwise("string")
        flag = F.when(F.col(f"{c}_n") == 0, "empty-sample").when(boolean | dated.isNotNull(), F.lit(None)).when(is_("scientific"), "scientific-notation").when(is_("digits"), F.when(is_("zero"), "leading-zero")).when(~is_("decimal") & is_("some_decimal"), "mixed-parseable")
        return F.struct(F.lit(c).alias("column_name"), kind.alias("suggested_type"), flag.alias("red_flag"))

    return one.select(F.inline(F.array(*(row(c) for c in columns))))


def suggest_schema(types: DataFrame) -> DataFrame:
    return types.select(F.col("column_name").alias("name"), F.col("suggested_type").alias("type"), F.lit(True).alias("nullable"), F.lit(True).alias("required"))


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns (name, type, position) of two versions: added, removed, retyped, moved or same."""
    a = old.select("name", F.col("type").alias("old_type"), F.col("position").alias("old_position"))
    b = new.select("name", F.col("type").alias("new_type"), F.col("position").alias("new_position"))
    kind = F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed").when(F.col("old_type") != F.col("new_type"), "retyped").when(F.col("old_position") != F.col("new_position"), "moved").otherwise("same")
    return a.join(b, "name", "full_outer").withColumn("change", kind)


@dataclass
class Mask:
    """A file name mask as a regular expression, with the group and the type of each facet."""

    regex: str
    facets: dict[str, tuple[int, str, str]]

    def columns(self, name: Column) -> list[Column]:
        """Facets as typed columns, null where the name doesn't match or an optional part is missing."""
        out = []
        for facet, (group, kind, pattern) in self.facets.items():
            text = F.nullif(F.regexp_extract(name, self.regex, group), F.lit(""))
            value = F.to_date(F.try_to_timestamp(text, F.lit(pattern))) if kind == "date" else text.try_cast("long") if kind == "int" else text
            out.append(value.alias(facet))
        return out

    def error(self, name: Column) -> Column:
        return F.when(~name.rlike(self.regex), "filename-does-not-match-mask")


def _literal(text: str) -> str:
    """text as a pattern that Java and Python read alike."""
    return "".join(c if c.isalnum() or c in "_ " else rf"\{c}" for c in text)


def _date_facet(spec: str) -> tuple[str, str]:
    """The regular expression and the datetime pattern of a strptime format whose directives are numbers.

    A directive is as wide as what strftime writes for it, and its pattern letter repeated that often reads it.
    """
    regex, pattern, at = "", "", 0
    while at < len(spec):
        size = 2 if spec[at] == "%" else 1
        piece, at = spec[at : at + size], at + size
        if size == 1:
            regex, pattern = regex + _literal(piece), pattern + f"'{piece}'"
            continue
        shown = datetime(2001, 1, 1).strftime(piece) if piece in DIRECTIVES else ""
        if not shown.isdigit():
            raise ValueError(f"unsupported directive {piece!r}")
        regex, pattern = regex + f"[0-9]{{{len(shown)}}}", pattern + DIRECTIVES[piece][0] * len(shown)
    return regex, pattern


def _facet(spec: str) -> tuple[str, str, str]:
    """Regular expression, type and datetime pattern of what follows a facet's name."""
    if not spec:
        return "[^_/.]+", "string", ""
    if spec.endswith("d") and spec[:-1].isdigit():
        return f"[0-9]{{{int(spec[:-1])}}}", "int", ""
    if "%" in spec:
        regex, pattern = _date_facet(spec)
        return regex, "date", pattern
    raise ValueError(f"unsupported format {spec!r}")


def compile_mask(mask: str) -> Mask:
    """`{name}`, `{name:%Y%m%d}`, `{name:03d}` and one level of `[optional]` parts; the whole name must match."""
    facets: dict[str, tuple[int, str, str]] = {}

    def part(text: str) -> str:
        out = ""
        while text:
            plain, brace, text = text.partition("{")
            if "}" in plain:
                raise ValueError(f"}} without {{ in mask {mask!r}")
            out += _literal(plain)
            if brace:
                body, end, text = text.partition("}")
                name, _, spec = body.partition(":")
                if not end or not name.isidentifier() or name in facets:
                    raise ValueError(f"unclosed, unnamed or repeated facet {body!r} in mask {mask!r}")
                regex, kind, pattern = _facet(spec)
                facets[name] = (len(facets) + 1, kind, pattern)
                out += f"({regex})"
        return out

    regex, rest = "", mask
    while rest:
        before, open_, rest = rest.partition("[")
        if "]" in before:
            raise ValueError(f"] without [ in mask {mask!r}")
        regex += part(before)
        if open_:
            inner, close, rest = rest.partition("]")
            if not close or "[" in inner:
                raise ValueError(f"unclosed or nested [ in mask {mask!r}")
            regex += f"(?:{part(inner)})?"
    return Mask(rf"\A{regex}\z", facets)
