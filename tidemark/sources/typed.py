"""Types of whole columns of text, and typed scans that keep the cells they refuse.

A column's type is decided by all of its cells at once: each cell is of the least kind that holds it, and kinds join to the
least kind that holds both (integers in doubles, anything in text). That is an aggregate of one flag a kind, so it is one pass
with map-side sums over any number of columns, and parts of a table can be typed apart and joined. A typed scan casts cells
that are none of their column's type to null and can list them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What readers of CSV files commonly take for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: The kinds of cells from the least, with the pattern of a trimmed cell of each and the type of a column of such cells.
KINDS = {
    "boolean": (r"(?i)(true|false)", "boolean"),
    "integer": (r"[+-]?\d{1,18}", "bigint"),
    "double": (r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[+-]?(?i:inf|infinity)", "double"),
    "date": (r"\d{4}-\d{2}-\d{2}", "date"),
}
TEXT = "string"


@dataclass(frozen=True)
class ColumnType:
    """What is known of a column's cells: how many there are, are missing, and are of each kind and no lesser one."""

    name: str
    n: int
    missing: int
    kinds: dict[str, int]

    @property
    def type(self) -> str:
        there = {k for k, n in self.kinds.items() if n}
        if not there:
            return TEXT
        if there <= {"integer", "double"}:
            return KINDS["double" if "double" in there else "integer"][1]
        return KINDS[there.pop()][1] if len(there) == 1 and "text" not in there else TEXT

    def joined(self, other: ColumnType) -> ColumnType:
        return ColumnType(self.name, self.n + other.n, self.missing + other.missing, {k: self.kinds[k] + other.kinds[k] for k in self.kinds})


def _cell(name: str) -> Column:
    return F.trim(F.col(f"`{name}`"))


def _missing(name: str, missing: Sequence[str]) -> Column:
    return F.coalesce(_cell(name).isin(*missing), F.lit(True))


def _is(kind: str, name: str) -> Column:
    cell, (pattern, kept) = _cell(name), KINDS[kind]
    looks = cell.rlike(f"^(?:{pattern})$")
    return looks & cell.try_cast(kept).isNotNull()


def column_types(df: DataFrame, columns: Sequence[str] | None = None, missing: Sequence[str] = MISSING) -> list[ColumnType]:
    """The type of each column of text, from all cells in one pass. An empty column, or one of missing cells, is text."""
    columns = list(columns or df.columns)
    sums = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(columns):
        kind = F.when(_missing(name, missing), "missing")
        for k in KINDS:
            kind = kind.when(_is(k, name), k)
        kind = kind.otherwise("text")
        sums += [F.count_if(kind == k).alias(f"{k}_{i}") for k in ("missing", *KINDS, "text")]
    found = df.agg(*sums).first()
    return [ColumnType(name, found["n"], found[f"missing_{i}"], {k: found[f"{k}_{i}"] for k in (*KINDS, "text")}) for i, name in enumerate(columns)]


def coerced(df: DataFrame, types: dict[str, str], missing: Sequence[str] = MISSING) -> DataFrame:
    """The columns cast to the types given; missing cells and those of another kind become null. Other columns stay."""
    cast = lambda c: F.when(~_missing(c, missing), _cell(c).try_cast(types[c]) if types[c] != TEXT else F.col(f"`{c}`"))
    return df.select(*[cast(c).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def rejected(df: DataFrame, types: dict[str, str], key: str, missing: Sequence[str] = MISSING) -> DataFrame:
    """(key, column, cell) of the cells that ``coerced`` makes null though they aren't missing."""
    bad = [F.when(~_missing(c, missing) & _cell(c).try_cast(t).isNull(), F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("cell"))) for c, t in types.items() if t != TEXT]
    if not bad:
        return df.select(key, F.lit("").alias("column"), F.lit("").alias("cell")).limit(0)
    return df.select(key, F.explode(F.array_compact(F.array(*bad))).alias("r")).select(key, "r.column", "r.cell")


def typed(df: DataFrame, key: str, missing: Sequence[str] = MISSING) -> tuple[DataFrame, dict[str, str]]:
    """A table of text with every column but ``key`` in the type that all its cells have."""
    types = {t.name: t.type for t in column_types(df, [c for c in df.columns if c != key], missing)}
    return coerced(df, types, missing), types
