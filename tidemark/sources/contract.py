"""What a data set promises: its columns, dialect and rules, checked when it is made; and rows normalised by it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as n
from ..operators.quality import Rule
from .detect import SourceError

TYPES = tuple(n.GOLD_TYPES)


@dataclass(frozen=True)
class ColumnContract:
    """numbers for integer and decimal columns, date_format for date and timestamp ones, tokens for boolean ones."""

    name: str
    type: str = "string"
    nullable: bool = True
    required: bool = True
    business_key: bool = False
    null_tokens: tuple[str, ...] = ("",)
    numbers: n.NumberProfile = field(default_factory=n.NumberProfile)
    date_format: str | None = None
    pivot: int | None = None
    zone: str | None = None
    fold: str = "reject"
    true_tokens: tuple[str, ...] = ("true",)
    false_tokens: tuple[str, ...] = ("false",)

    def text(self) -> Column:
        return n.null_tokens(F.col(f"`{self.name}`"), self.null_tokens if self.nullable else ())

    def outcome(self) -> Column:
        """The normalised text and error of this column's text."""
        text = self.text()
        if self.type in ("integer", "decimal"):
            return n.decimal(text, self.numbers)
        if self.type in ("date", "timestamp"):
            form = self.date_format or ("%Y-%m-%d" if self.type == "date" else "%Y-%m-%dT%H:%M:%S%z")
            return n.local_timestamp(text, form, self.zone, self.fold, self.pivot) if self.zone else n.date(text, form, self.pivot)
        if self.type == "boolean":
            return n.boolean(text, self.true_tokens, self.false_tokens)
        return n.outcome(n.nfc(text))


@dataclass(frozen=True)
class DatasetContract:
    name: str
    columns: tuple[ColumnContract, ...]
    delimiter: str | None = None
    dedup_keys: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    strategy: str = "upsert"

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        problems = [
            *(f"unknown-type: {c.name} {c.type}" for c in self.columns if c.type not in TYPES),
            *(f"duplicate-column: {x}" for x in dict.fromkeys(x for x in names if names.count(x) > 1)),
            *(f"delimiter-is-decimal-separator: {c.name}" for c in self.columns if self.delimiter is not None and c.type in ("integer", "decimal") and c.numbers.decimal_separator == self.delimiter),
            *(f"dedup-key-is-no-business-key: {k}" for k in self.dedup_keys if k not in [c.name for c in self.columns if c.business_key]),
            *(["several-business-keys"] if sum(c.business_key for c in self.columns) > 1 else []),
            *(f"pivot-missing: {c.name}" for c in self.columns if c.date_format and "%y" in c.date_format and c.pivot is None),
            *(f"rule-on-unknown-column: {r.column}" for r in self.rules if r.column not in names),
        ]
        if problems:
            raise SourceError("invalid-contract", "; ".join(problems))

    @property
    def business_key(self) -> str | None:
        return next((c.name for c in self.columns if c.business_key), None)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def with_sentinels(contract: DatasetContract, sentinels: Mapping[str, Sequence[str]]) -> DatasetContract:
    """The contract with more null tokens by column."""
    from dataclasses import replace

    if unknown := set(sentinels) - set(contract.names):
        raise SourceError("invalid-contract", f"sentinels of unknown columns: {sorted(unknown)}")
    return replace(contract, columns=tuple(replace(c, null_tokens=(*c.null_tokens, *sentinels.get(c.name, ()))) for c in contract.columns))


def _once(df: DataFrame, **made: Column) -> DataFrame:
    """df with more columns, each computed once per row however often it is read: filters don't move below a generator and take them along."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in made.items())))))


@dataclass
class Normalised:
    """good has the values; rejects the row's first error, its column and the raw line."""

    good: DataFrame
    rejects: DataFrame


def _separated(rows: DataFrame, contract: DatasetContract, outcomes: dict[str, Column]) -> Normalised:
    """outcomes: by column of the contract, structs of value and error, of which the first in the contract's order counts."""
    judged = _once(rows, **{f"_o{k}": outcomes[c] for k, c in enumerate(contract.names)})
    errors = [F.when(F.col(f"_o{k}.error").isNotNull(), F.struct(F.lit(c).alias("column"), F.col(f"_o{k}.error").alias("error"))) for k, c in enumerate(contract.names)]
    judged = judged.withColumn("_error", F.coalesce(*errors))
    others = [F.col(f"`{c}`") for c in rows.columns if c not in contract.names]
    good = judged.filter("_error IS NULL").select(*(F.col(f"_o{k}.value").alias(c) for k, c in enumerate(contract.names)), *others)
    raw = n.raw_line(*(F.col(f"`{c}`") for c in contract.names)).alias("raw_line")
    return Normalised(good, judged.filter("_error IS NOT NULL").select(*others, F.col("_error.error").alias("error_type"), F.col("_error.column").alias("error_column"), raw))


def normalised(rows: DataFrame, contract: DatasetContract) -> Normalised:
    """rows (the contract's columns as text, and others, which stay) with every value normalised; NUL characters go first.

    A null text is absent, an empty one what the column's null tokens make of it. An empty table gives empty ones.
    """
    clean = rows.select(*(n.strip_nul(F.col(f"`{c}`")).alias(c) if c in contract.names else F.col(f"`{c}`") for c in rows.columns))
    # What goes by Python can't stand in a generator.
    composed = clean.select("*", *(n.nfc(c.text()).alias(f"_n{k}") for k, c in enumerate(contract.columns) if c.type == "string"))
    made = {c.name: n.outcome(F.col(f"_n{k}")) if c.type == "string" else c.outcome() for k, c in enumerate(contract.columns)}
    found = _separated(composed, contract, made)
    extra = [x for x in composed.columns if x not in clean.columns]
    return Normalised(found.good.drop(*extra), found.rejects.drop(*extra))


def typed_rows(good: DataFrame, contract: DatasetContract) -> Normalised:
    """Normalised texts as the contract's types, as they are published; rows that don't fit are rejects, none becomes null silently."""
    return _separated(good, contract, {c.name: n.typed(F.col(f"`{c.name}`"), c.type) for c in contract.columns})
