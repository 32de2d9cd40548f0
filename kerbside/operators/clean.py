"""Projection, cleaning and row filters.

Every operator takes a DataFrame and column names.  Filters spell out what happens
to NULL, since ``x <= limit`` alone would drop the rows where ``x`` is unknown.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import columns as fc


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that are there."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def sentinels_to_null(df: DataFrame, sentinels: dict[str, list]) -> DataFrame:
    return df.withColumns(
        {c: fc.sentinel_to_null(c, values) for c, values in sentinels.items() if c in df.columns})


def packed(df: DataFrame, columns: list[str], into: str = "_packed") -> DataFrame:
    """Integer columns as one column for an exchange: a byte each, or as they are in rows with larger ones."""
    if not columns:
        return df
    small = F.array(*[F.col(c).try_cast("tinyint") for c in columns])
    fits = reduce(lambda a, b: a & b, [F.col(c).isNull() | F.col(c).between(-128, 127) for c in columns])
    whole = F.when(~fits, F.array(*[F.col(c).cast("bigint") for c in columns]))
    return df.withColumns({into: F.when(fits, small), into + "_whole": whole}).drop(*columns)


def unpacked(df: DataFrame, columns: dict[str, str], packed: str = "_packed") -> DataFrame:
    """The ``columns`` (name to type) that ``packed`` made one."""
    return df.withColumns({c: F.coalesce(F.col(packed)[i].cast(kind), F.col(packed + "_whole")[i].cast(kind))
                           for i, (c, kind) in enumerate(columns.items())}).drop(packed, packed + "_whole")


def integers(df: DataFrame) -> dict[str, str]:
    """Columns of whole numbers up to 32 bits, with their types."""
    return {c: kind for c, kind in df.dtypes if kind in ("tinyint", "smallint", "int") and c[0] != "_"}


def keep_up_to(df: DataFrame, column: str, limit) -> DataFrame:
    """Drop rows above ``limit``; rows where the column is unknown stay."""
    return df.filter(F.col(column).isNull() | (F.col(column) <= limit))


def keep_valid_dates(df: DataFrame, year, month, day, into: str | None = None) -> DataFrame:
    """Keep rows whose three numbers form a date of the calendar."""
    date = fc.valid_date(year, month, day)
    return df.withColumn(into, date).filter(F.col(into).isNotNull()) if into \
        else df.filter(date.isNotNull())


def drop_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def to_smallint(df: DataFrame, columns: list[str]) -> DataFrame:
    """16-bit integers for the columns that are there; NULL and overflow give NULL."""
    return df.withColumns({c: F.col(c).try_cast("smallint") for c in columns if c in df.columns})


def complete_rows(df: DataFrame, meaningful: list[str], missing=-1) -> DataFrame:
    """Rows without unknowns.

    ``missing`` counts as unknown except in the ``meaningful`` columns, where it says
    "not applicable" and also replaces NULL.
    """
    def clean(name: str, kind: str) -> Column:
        col = F.col(name)
        if name in meaningful:
            return F.coalesce(col, F.lit(missing).cast(kind))
        unknown = col == F.lit(str(missing)) if kind == "string" else col == F.lit(missing)
        return F.when(~unknown, col)
    cleaned = df.select([clean(n, k).alias(n) for n, k in df.dtypes])
    return cleaned.dropna("any")


def drop_sentinel_rows(df: DataFrame, columns: list[str], missing=-1) -> DataFrame:
    tests = [F.coalesce(F.col(c) != missing, F.lit(True)) for c in columns]
    return df.filter(reduce(lambda a, b: a & b, tests))


def fixed_domains(df: DataFrame, domains: dict[str, list], suffix: str = "_code") -> DataFrame:
    """Ordinal position of each column in its domain, as a new column."""
    return df.withColumns(
        {c + suffix: fc.ordinal_code(c, d) for c, d in domains.items() if c in df.columns})


def decode(df: DataFrame, books: dict[str, dict], suffix: str = "_label") -> DataFrame:
    return df.withColumns({c + suffix: fc.decode(c, b) for c, b in books.items() if c in df.columns})


def keep_non_numeric(df: DataFrame, column: str) -> DataFrame:
    return df.filter(fc.is_not_number(column))


def by_key(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value)


def share_where(df: DataFrame, predicate: Column, name: str = "share") -> DataFrame:
    """Share of rows that satisfy the predicate (unknown counts as no)."""
    return df.agg(F.avg(F.when(predicate, 1.0).otherwise(0.0)).alias(name))


def split_by_year(df: DataFrame, year, test_years: list[int],
                  train_years: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) by year; train is every other year unless given."""
    y = F.col(year) if isinstance(year, str) else year
    train = ~y.isin(test_years) if train_years is None else y.isin(train_years)
    return df.filter(train), df.filter(y.isin(test_years))
