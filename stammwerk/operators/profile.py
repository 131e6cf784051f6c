"""What a load holds: counts and sketches per column, merged over loads and compared.

One pass over a load gives, per column, exact counts of rows and nulls, a sketch of the number
of different values (relative error about 1.6 %, one standard deviation), one of the quantiles
of numbers, dates and times (rank error about 1.7 %), and one of frequent values. A second
aggregation counts exactly how many rows repeat a key. Profiles are small, can be stored with
their book date, and are merged without looking at the rows again; a later load is held
against the merged ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stammwerk.functions.load_metadata import BOOK_DATE
from stammwerk.operators.gate import Finding
from stammwerk.plans.feeds import DELTA
from stammwerk.sinks.writers import write_table

HLL_BITS = 12
KLL_K = 200
TRACKED = 256  # values a sketch of frequent values follows
QUARTILES = (0.25, 0.5, 0.75)


def _as_number(field: T.StructField) -> Column | None:
    """A column as a double, for its quantiles; None where it has none."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.NumericType):
        return column.cast("double")
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return None


def _top(column: Column) -> Column:
    return F.call_function("approx_top_k_accumulate", column, F.lit(TRACKED))


def profile(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(column, rows, nulls, repeats, hll, kll, top) of every column.

    ``repeats`` is how many rows have a key that another row has before them; the same for
    all columns, null without ``keys``, and counted at once. Columns of maps are left out.
    """
    fields = [f for f in df.schema if not isinstance(f.dataType, T.MapType)]
    found, shown = [], []
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        text = column.cast("string") if isinstance(field.dataType, T.AtomicType) else F.to_json(column)
        number = _as_number(field)
        found += [
            F.count(F.when(column.isNull(), 1)).alias(f"nulls{i}"),
            F.hll_sketch_agg(text, HLL_BITS).alias(f"hll{i}"),
            _top(text).alias(f"top{i}"),
        ]
        quantiles = F.lit(None).cast("binary")
        if number is not None:
            found.append(F.kll_sketch_agg_double(number, F.lit(KLL_K)).alias(f"kll{i}"))
            quantiles = F.col(f"kll{i}")
        shown.append(
            F.struct(
                F.lit(field.name).alias("column"), F.col("rows"), F.col(f"nulls{i}").alias("nulls"),
                F.col(f"hll{i}").alias("hll"), quantiles.alias("kll"), F.col(f"top{i}").alias("top"),
            )
        )
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *found)
    repeats = F.lit(None).cast("long")
    if keys:
        by_key = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("again"))
        repeats = F.lit(by_key.agg(F.coalesce(F.sum("again"), F.lit(0))).first()[0])
    exploded = totals.select(F.explode(F.array(*shown)).alias("p"), repeats.alias("repeats"))
    return exploded.select("p.column", "p.rows", "p.nulls", "repeats", "p.hll", "p.kll", "p.top")


def store_profile(profiled: DataFrame, table: str, book_date: date | str) -> str:
    """Keep a profile under its book date, replacing an earlier one of that date."""
    dated = profiled.withColumn(BOOK_DATE, F.lit(str(book_date)).cast("date"))
    if profiled.sparkSession.catalog.tableExists(table):
        return write_table(dated, table, DELTA, replace_partition={BOOK_DATE: str(book_date)})
    return write_table(dated, table, DELTA, [BOOK_DATE], gather=False)


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """One profile of all loads together, per column; repeats within loads are added up."""
    return profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.sum("repeats").alias("repeats"),
        F.hll_union_agg("hll", F.lit(True)).alias("hll"),
        F.kll_merge_agg_double("kll").alias("kll"),
        F.call_function("approx_top_k_combine", F.col("top"), F.lit(TRACKED)).alias("top"),
    )


def estimates(profiled: DataFrame, frequent: int = 5) -> DataFrame:
    """(column, rows, nulls, repeats, distinct, quartiles, frequent) of profiles."""
    has_numbers = F.col("kll").isNotNull() & (F.kll_sketch_get_n_double("kll") > 0)
    quartiles = F.when(
        has_numbers, F.array(*[F.kll_sketch_get_quantile_double("kll", F.lit(q)) for q in QUARTILES])
    )
    return profiled.select(
        "column", "rows", "nulls", "repeats",
        F.hll_sketch_estimate("hll").alias("distinct"),
        quartiles.alias("quartiles"),
        F.call_function("approx_top_k_estimate", F.col("top"), F.lit(frequent)).alias("frequent"),
    )


@dataclass(frozen=True)
class Limits:
    """How far a load may be from the earlier ones; None does not look."""

    repeats: int | None = 0
    rows_ratio: tuple[float, float] | None = (0.5, 2.0)  # of an earlier load's mean
    null_share: float | None = 0.1  # how much it may grow
    rank_shift: float | None = 0.25  # where the earlier median is found among the new values
    new_frequent: float | None = 0.5  # share of one value that was not frequent before
    growing: tuple[str, ...] = ()  # columns, such as ids and dates, whose values move on


def content_findings(load: DataFrame, earlier: DataFrame | None, limits: Limits = Limits()) -> list[Finding]:
    """What the profile of a load says, held against the stored profiles of earlier ones.

    Without earlier loads only repeats are judged. A column that earlier loads lack is not
    judged. The findings have the form of the schema gate's, the good ones included.
    """
    findings = []

    def add(check: str, column: str, expected: str, actual: object, ok: bool) -> None:
        findings.append(Finding(check, column, expected, str(actual), bool(ok)))

    now = {r.column: r for r in estimates(load).collect()}
    first = next(iter(now.values()), None)
    if first is not None and first.repeats is not None and limits.repeats is not None:
        add("key_repeats", "", f"at most {limits.repeats}", first.repeats, first.repeats <= limits.repeats)
    if earlier is None:
        return findings
    merged = merge_profiles(earlier)
    before = {r.column: r for r in estimates(merged).collect()}
    loads = earlier.select(BOOK_DATE).distinct().count() or 1
    if limits.rows_ratio and first is not None and before:
        mean = next(iter(before.values())).rows / loads
        low, high = (limits.rows_ratio[0] * mean, limits.rows_ratio[1] * mean)
        add("row_count", "", f"{low:g} to {high:g}", first.rows, low <= first.rows <= high)
    shifted = {}
    medians = {c: r.quartiles[1] for c, r in before.items() if r.quartiles and now.get(c) and now[c].quartiles and c not in limits.growing}
    if limits.rank_shift is not None and medians:
        ranks = [
            F.when(F.col("column") == c, F.kll_sketch_get_rank_double("kll", F.lit(m))) for c, m in medians.items()
        ]
        judged = load.where(F.col("column").isin(list(medians)))
        shifted = {r.column: r.rank for r in judged.select("column", F.coalesce(*ranks).alias("rank")).collect()}
    for column, r in now.items():
        old = before.get(column)
        if old is None or not r.rows or not old.rows:
            continue
        if limits.null_share is not None:
            share, most = r.nulls / r.rows, old.nulls / old.rows + limits.null_share
            add("null_share", column, f"at most {most:.3f}", f"{share:.3f}", share <= most)
        if column in shifted:
            away = abs(shifted[column] - 0.5)
            add("median", column, f"within {limits.rank_shift}", f"{away:.3f}", away <= limits.rank_shift)
        if limits.new_frequent is not None and r.frequent and column not in limits.growing:
            known = {x.item for x in old.frequent}
            fresh = [(x["count"] / r.rows, x.item) for x in r.frequent if x.item not in known and x.item is not None]
            share, value = max(fresh, default=(0.0, ""))
            add("new_value", column, f"below {limits.new_frequent}", f"{share:.3f} {value}", share < limits.new_frequent)
    return findings


def earlier_profiles(spark: SparkSession, table: str, book_date: date | str) -> DataFrame | None:
    """The stored profiles of book dates before this one; None if there are none."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.table(table).where(F.col(BOOK_DATE) < F.lit(str(book_date)).cast("date"))
    return None if rows.isEmpty() else rows
