"""Column clean-up, typing and derived columns. Every function returns a transform."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, NumericType, StringType, StructType

from tidemill.functions import labels
from tidemill.functions.casting import safe_cast

Transform = Callable[[DataFrame], DataFrame]


def _unique(names: Sequence[str]) -> list[str]:
    repeated = [n for n, k in Counter(names).items() if k > 1]
    if repeated:
        raise ValueError(f"column names collide: {repeated}")
    return list(names)


def normalise_names(df: DataFrame) -> DataFrame:
    """Snake case names; raises when two columns would get one name."""
    return df.toDF(*_unique([re.sub(r"[^0-9a-zA-Z]+", "_", c).strip("_").lower() for c in df.columns]))


def suffix_names(suffix: str) -> Transform:
    return lambda df: df.toDF(*[c + suffix for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*_unique([c.lower() for c in df.columns]))


def drop_audit(df: DataFrame) -> DataFrame:
    """Only the data columns; audit columns start with two underscores."""
    return df.select(*[c for c in df.columns if not c.startswith("__")])


def fill_strings(value: str = "-") -> Transform:
    def fill(df: DataFrame) -> DataFrame:
        return df.na.fill(value, [f.name for f in df.schema if isinstance(f.dataType, StringType)])

    return fill


def fill_numbers(value: float = 0.0) -> Transform:
    def fill(df: DataFrame) -> DataFrame:
        return df.na.fill(value, [f.name for f in df.schema if isinstance(f.dataType, NumericType)])

    return fill


def fill_column(column: str, value: object) -> Transform:
    return lambda df: df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def drop_null_keys(keys: Sequence[str]) -> Transform:
    """Rows with a null in any key are dropped; no keys, no change."""
    return lambda df: df.na.drop(subset=list(keys)) if keys else df


def impose_types(types: dict[str, DataType | str]) -> Transform:
    """Cast the named columns, bad values become null; absent names are skipped."""

    def cast(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                safe_cast(F.col(f.name), types[f.name], f.dataType).alias(f.name) if f.name in types else F.col(f.name)
                for f in df.schema
            ]
        )

    return cast


def impose_schema(schema: StructType) -> Transform:
    """Cast to the types of a schema; audit columns are left as they are."""
    return impose_types({f.name: f.dataType for f in schema if not f.name.startswith("__")})


def truncate_times(columns: Sequence[str], unit: str = "second") -> Transform:
    def truncate(df: DataFrame) -> DataFrame:
        present = [c for c in columns if c in df.columns]
        return df.withColumns({c: F.date_trunc(unit, c) for c in present}) if present else df

    return truncate


def trim_strings(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.trim(c) for c in text}) if text else df


def clean_strings(columns: Sequence[str]) -> Transform:
    return lambda df: df.withColumns({c: F.lower(F.trim(c)) for c in columns})


def audit_stamps(run_ts: str, user: str) -> Transform:
    """Created, updated and created-by; the run time is an argument, so a rerun gives the same rows."""
    at = F.lit(run_ts).cast("timestamp_ntz")
    return lambda df: df.withColumns({"created_at": at, "updated_at": at, "created_by": F.lit(user)})


def split_valid(df: DataFrame, types: dict[str, DataType | str], required: Sequence[str]) -> DataFrame:
    """Type an all-text feed in one pass.

    ``__reason`` names the required columns that are missing or did not parse;
    it is null for a valid row.
    """
    typed = {c: safe_cast(F.col(c), t, df.schema[c].dataType) for c, t in types.items()}
    faults = [
        F.when(F.col(c).isNull(), F.lit(f"{c} missing")).when(typed.get(c, F.col(c)).isNull(), F.lit(f"{c} unreadable"))
        for c in required
    ]
    reason = F.concat_ws("; ", *faults)
    return df.select(
        *[typed[c].alias(c) if c in typed else F.col(c) for c in df.columns],
        F.when(reason != "", reason).alias("__reason"),
    )


def notional(quantity: str, price: str, rate: str, out: str, scale: int = 2) -> Transform:
    """quantity x price x rate, rounded half up on exact decimals."""

    def add(df: DataFrame) -> DataFrame:
        exact = (
            F.col(quantity).cast("decimal(12,2)") * F.col(price).cast("decimal(12,2)") * F.col(rate).cast("decimal(12,4)")
        )
        return df.withColumn(out, F.round(exact, scale).cast("double"))

    return add


def value_label(column: str, mapping: list[tuple[object, str]], out: str | None = None, default: str | None = None) -> Transform:
    return lambda df: df.withColumn(out or f"{column}_label", labels.value_label(F.col(column), mapping, default))


def label_by_table(df: DataFrame, column: str, table: DataFrame, out: str, default: str | None = None) -> DataFrame:
    """A long value map given as a table (value, label); Spark broadcasts it when it is small."""
    looked_up = df.join(table.toDF(column, "__label"), column, "left")
    return looked_up.select(*df.columns, F.coalesce(F.col("__label"), F.lit(default)).alias(out))


def date_lag(later: str, earlier: str, out: str) -> Transform:
    return lambda df: df.withColumn(out, F.datediff(F.to_date(later), F.to_date(earlier)))


def date_parts(column: str) -> Transform:
    """Parsed date, month label, one month on, quarter, weekday number and name, month start."""

    def add(df: DataFrame) -> DataFrame:
        day = F.to_date(column)
        return df.withColumns(
            {
                "txn_date": day,
                "year_month": F.date_format(day, "yyyy-MM"),
                "one_month_later": F.add_months(day, 1),
                "quarter": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
                "day_of_week": F.dayofweek(day),
                "day_name": F.date_format(day, "EEEE"),
                "month_start": F.trunc(day, "month"),
            }
        )

    return add


def time_periods(column: str) -> Transform:
    """Calendar quarter, half, four-month round and period label."""

    def add(df: DataFrame) -> DataFrame:
        month, quarter = F.month(column), F.concat(F.lit("Q"), F.quarter(column).cast("string"))
        return df.withColumns(
            {
                "calendar_quarter": quarter,
                "fiscal_half": labels.first_match([(month <= 6, "H1"), (month > 6, "H2")]),
                "business_round": labels.first_match([(month <= 4, "R1"), (month <= 8, "R2"), (month > 8, "R3")]),
                "period_label": labels.quarter_label(F.col(column)),
            }
        )

    return add


def one_hot(column: str, values: Sequence[str], prefix: str = "") -> Transform:
    """An int column per listed value."""
    return lambda df: df.withColumns(
        {f"{prefix}{v}".lower(): F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values}
    )


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def growth_sign(recent: Column, past: Column) -> Column:
    """1, 0 or -1 by comparing whole parts, as the growth flags do."""
    r, p = recent.cast("bigint"), past.cast("bigint")
    return F.when(r > p, 1).when(r < p, -1).otherwise(0)
