"""Agreement of two extractors on the same facts, fact by fact."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingmill.functions.exprs import MONEY, within_tolerance

CONFLICT = "blocked_extractor_conflict"


#: Repeats of one row that are made at a time.
CHUNK = 1 << 16


def repeated(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """Every row once for each number from ``first`` to ``last``, as column ``name``; long runs are made in chunks, not in one array."""
    starts = df.withColumns({"__from": first.cast("bigint"), "__to": last.cast("bigint")}).where("__from <= __to")
    chunks = starts.withColumn("__at", F.explode(F.sequence("__from", "__to", F.lit(CHUNK).cast("bigint"))))
    return chunks.withColumn(name, F.explode(F.sequence("__at", F.least(F.col("__at") + CHUNK - 1, "__to")))).drop("__from", "__to", "__at")


def _sided(df: DataFrame, keys: Sequence[str], value: str, side: str) -> DataFrame:
    other = "b" if side == "a" else "a"
    return df.select(*keys, F.col(value).cast(MONEY).alias("__v"), F.lit(1).alias(f"__{side}"), F.lit(0).alias(f"__{other}"))


def agreement(a: DataFrame, b: DataFrame, keys: Sequence[str], absolute: Decimal | str = "2", relative: Decimal | str = "0.0001", value: str = "normalized_value") -> DataFrame:
    """(keys, value_a, value_b, agreement_status): every fact of both sides once, paired one to one within null-safe keys.

    Equal values are paired first, as often as both sides have them. The rest of a key is sorted and cut
    where neighbours lie farther apart than any tolerance; within such a stretch the values of both sides are paired
    in order. What is left of a key, missing values last, stands side by side in order as conflicts, as are pairs beyond the
    tolerance; no side is ever chosen. Values are counted before they meet, so repeated facts of a key send one row each side.
    """
    both = _sided(a, keys, value, "a").unionByName(_sided(b, keys, value, "b"))
    counted = both.groupBy(*keys, "__v").agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    same = F.when(F.col("__v").isNull(), F.lit(0)).otherwise(F.least("__a", "__b"))
    counted = counted.withColumn("__same", same)
    equal = repeated(counted.select(*keys, F.col("__v").alias("value_a"), F.col("__v").alias("value_b"), "__same"), F.lit(1), F.col("__same"), "__n")
    equal = equal.select(*keys, "value_a", "value_b", F.lit("agreed").alias("agreement_status"))
    left = counted.select(*keys, "__v", (F.col("__a") - F.col("__same")).alias("__a"), (F.col("__b") - F.col("__same")).alias("__b"))
    place = Window.partitionBy(*keys).orderBy("__v")
    gap = F.col("__v") - F.lag("__v").over(place)
    reach = F.greatest(F.abs("__v"), F.abs(F.lag("__v").over(place)))
    # twice the relative tolerance: the sides' own values may be smaller than the greater of two neighbours
    wide = Decimal(str(relative)) * 2
    cut = ~within_tolerance(gap, reach, absolute, wide)
    some = left.where("__v is not null and __a + __b > 0").withColumn("__new", F.coalesce(cut.cast("int"), F.lit(1)))
    stretch = some.withColumn("__stretch", F.sum("__new").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    order = Window.partitionBy(*keys, "__stretch").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)

    def ranked(side: str) -> DataFrame:
        n = f"__{side}"
        own = stretch.withColumn("__end", F.sum(n).over(order)).where(f"{n} > 0")
        own = repeated(own, F.col("__end") - F.col(n) + 1, F.col("__end"), "__r")
        return own.select(*[F.col(k).alias(f"{k}_{side}") for k in keys], F.col("__stretch").alias(f"s_{side}"), F.col("__v").alias(f"value_{side}"), F.col("__r").alias(f"r_{side}"))

    same_key = reduce(and_, [F.col(f"{k}_a").eqNullSafe(F.col(f"{k}_b")) for k in keys])
    paired = ranked("a").join(ranked("b"), same_key & (F.col("s_a") == F.col("s_b")) & (F.col("r_a") == F.col("r_b")), "full_outer")

    def alone(side: str) -> DataFrame:
        other = "b" if side == "a" else "a"
        named = [F.col(k).alias(f"{k}_{side}") for k in keys]
        missing = repeated(left.where("__v is null"), F.lit(1), F.col(f"__{side}"), "__n").select(*named, F.col("__v").alias(f"value_{side}"))
        own = paired.where(F.col(f"r_{other}").isNull()).select(*[f"{k}_{side}" for k in keys], f"value_{side}").unionByName(missing)
        return own.withColumn(f"r_{side}", F.row_number().over(Window.partitionBy(*[f"{k}_{side}" for k in keys]).orderBy(F.col(f"value_{side}").asc_nulls_last())))

    def told(rows: DataFrame, status: Column) -> DataFrame:
        in_a = F.col("r_a").isNotNull()
        return rows.select(*[F.when(in_a, F.col(f"{k}_a")).otherwise(F.col(f"{k}_b")).alias(k) for k in keys], "value_a", "value_b", status.alias("agreement_status"))

    near = within_tolerance(F.col("value_a") - F.col("value_b"), "value_a", absolute, relative)
    both_there = paired.where(F.col("r_a").isNotNull() & F.col("r_b").isNotNull())
    rest = alone("a").join(alone("b"), same_key & (F.col("r_a") == F.col("r_b")), "full_outer")
    return equal.unionByName(told(both_there, F.when(near, "agreed").otherwise(CONFLICT))).unionByName(told(rest, F.lit(CONFLICT)))


#: What facts of two extractors must have in common, besides their report, to be held against each other.
FACT_KEYS = ("report_id", "normalized_concept_id", "period_basis", "period_end", "instant_date", "statement_scope")


def run_agreement(facts: DataFrame, run_a: str, run_b: str, absolute: Decimal | str = "2", relative: Decimal | str = "0.0001") -> DataFrame:
    """``agreement`` of the mapped facts of two extraction runs, by concept, basis, date and scope."""
    of = lambda run: facts.where((F.col("extraction_run_id") == run) & F.col("normalized_concept_id").isNotNull())
    return agreement(of(run_a), of(run_b), FACT_KEYS, absolute, relative)
