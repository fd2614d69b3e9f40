"""Exact money sums.

Adding doubles gives a result that changes with the partitioning. Here every amount counts
as the decimal number that it is written as, and all are added as integers, so any finite
amounts, however large or small, have one sum.

An amount of whole cents, the usual case, is added as a 64-bit integer in two parts, which
costs little and holds a billion rows of the largest such amount. Any other amount is
split into its digits and a power of ten. Powers of ten are binned by sixes: within a bin
digits are whole numbers of one unit, and are added as such. A group's partial sums are
thus one row for the cents and one for each bin that occurs, at most a hundred or so. They
can be merged, kept, and taken back with a negative sign. Only the end result is
put together from the bins, by carrying from one to the next, and rounded once.

A group with an infinite amount has an infinite total; with both signs of it, or with a
NaN, the total is NaN. Null amounts are skipped; a group of nothing else has no total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to here a double holds whole cents, and the product with 100 is exact enough to find them.
_CENTS_BOUND = 9e13
_LOW = 1_000_000
# Digits of a bin; the unit of bin b is 10 to the power of _WIDTH * b.
_WIDTH = 6
_BASE = 10**_WIDTH

_SUMS = ("_high", "_low", "_units", "_up", "_down", "_nan", "_known", "_rows")
#: What :func:`partial_sums` adds to the group's columns, as DDL.
PARTIAL_SCHEMA = (
    "_bin int, _high bigint, _low bigint, _units decimal(38,0), _up bigint, _down bigint, "
    "_nan bigint, _known bigint, _rows bigint"
)


def _digits(amount: Column) -> tuple[Column, Column]:
    """The bin of a finite amount and its number of the bin's units."""
    parts = F.split(amount.cast("string"), "E")
    written, power = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    decimals = F.length(written) - F.instr(written, ".")
    lowest = F.coalesce(power.cast("int"), F.lit(0)) - decimals
    at = F.floor(lowest / float(_WIDTH)).cast("int")
    zeros = F.repeat(F.lit("0"), lowest - at * _WIDTH)
    return at, F.concat(F.replace(written, F.lit("."), F.lit("")), zeros).cast("decimal(25,0)")


def partial_sums(df: DataFrame, keys: Sequence[str | Column], amount: str, sign: str | None = None) -> DataFrame:
    """A row for each group and bin with its sums. Rows whose ``sign`` is -1 are taken back.

    One aggregation with partial results before the shuffle; a group's rows are few.
    """
    a = F.col(amount).cast("double")
    # floor, not round: rounding a double goes through decimal text for every row.
    cents = F.when(F.abs(a) < _CENTS_BOUND, F.floor(a * 100 + 0.5))
    usual = F.coalesce(cents.cast("double") / 100.0 == a, F.lit(False))
    finite = F.abs(a) < float("inf")
    odd = F.when(~usual & finite, a)
    at, units = _digits(odd)
    one = F.lit(1) if sign is None else F.col(sign)

    def counted(test: Column) -> Column:
        return F.sum(F.when(test, one).otherwise(0)).cast("long")

    in_cents = F.when(usual, cents)
    low = F.pmod(in_cents, F.lit(_LOW))
    high = F.call_function("div", in_cents - low, F.lit(_LOW))
    rows = df.withColumns({"_bin": at, "_in_high": high, "_in_low": low, "_in_units": units})
    return rows.groupBy(*keys, "_bin").agg(
        F.sum(F.col("_in_high") * one).alias("_high"),
        F.sum(F.col("_in_low") * one).alias("_low"),
        F.sum(F.col("_in_units") * one).cast("decimal(38,0)").alias("_units"),
        counted(a == float("inf")).alias("_up"),
        counted(a == float("-inf")).alias("_down"),
        counted(F.isnan(a)).alias("_nan"),
        counted(a.isNotNull()).alias("_known"),
        F.sum(one).cast("long").alias("_rows"),
    )


def merged(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Several partial sums of a group as one, without what was all taken back."""
    sums = [F.sum(c).alias(c) for c in _SUMS if c != "_units"]
    units = F.sum("_units").cast("decimal(38,0)").alias("_units")
    left = partials.groupBy(*keys, "_bin").agg(*sums, units).where("_rows <> 0 OR _known <> 0")
    return left.select(*keys, "_bin", *_SUMS)


_EXACT = "(cast(coalesce(_high, 0L) AS decimal(20,0)) * 10000BD + cast(coalesce(_low, 0L) AS decimal(20,0)) * 0.01BD)"


def _cents_by(n: str) -> str:
    """SQL for the sum of whole cents over ``n`` with two decimals, halves rounded away from zero.

    The remainder by a hundredth of ``n`` is exact and what is left divides evenly, so no
    step but the last rounds.
    """
    unit = f"(cast({n} AS decimal(20,0)) * 0.01BD)"
    rest = f"({_EXACT} % {unit})"
    cents = f"cast(({_EXACT} - {rest}) / {unit} AS decimal(30,0))"
    up = f"if(abs({rest}) * 2 >= {unit}, sign({rest}), 0)"
    return f"cast(({cents} + cast({up} AS decimal(1,0))) * 0.01BD AS double)"


# --- putting bins together: lists of digits to the base of a bin, lowest first ------


def _carried(digits: str) -> str:
    """Every digit within the base, and in ``carry`` what goes beyond the last one."""
    zero = "named_struct('carry', cast(0 AS decimal(38,0)), 'digits', cast(array() AS array<decimal(38,0)>))"
    digit = f"cast(pmod(acc.carry + v, {_BASE}BD) AS decimal(38,0))"
    return (
        f"aggregate({digits}, {zero}, (acc, v) -> named_struct("
        f"'carry', cast((acc.carry + v - {digit}) / {_BASE}BD AS decimal(38,0)), "
        f"'digits', concat(acc.digits, array({digit}))))"
    )


def _divided(digits: str, n: str) -> str:
    """Quotient digits, highest first, of carried digits by a whole number up to 9e12."""
    zero = "named_struct('rest', 0L, 'digits', cast(array() AS array<decimal(38,0)>))"
    value = f"(acc.rest * {_BASE}L + cast(v AS bigint))"
    return (
        f"aggregate(reverse({digits}), {zero}, (acc, v) -> named_struct("
        f"'rest', {value} % {n}, "
        f"'digits', concat(acc.digits, array(cast({value} div {n} AS decimal(38,0)))))).digits"
    )


def _with_half_cent(digits: str) -> str:
    return f"transform({digits}, (v, i) -> cast(v + if(i = -1 - _lowest, {_BASE // 200}BD, 0BD) AS decimal(38,0)))"


def _to_double(carried: str) -> str:
    """Of carried digits, cut after the second decimal; the text is read as the nearest double."""
    text = f"transform({carried}.digits, v -> lpad(cast(v AS string), {_WIDTH}, '0'))"
    whole = f"array_join(reverse(slice({text}, 1 - _lowest, size({text}))), '')"
    part = f"left({text}[-1 - _lowest], 2)"
    return f"cast(concat(if(_minus, '-', ''), cast({carried}.carry AS string), {whole}, '.', {part}) AS double)"


def totals(partials: DataFrame, keys: Sequence[str], total: str, n: str | None = None, mean: str | None = None) -> DataFrame:
    """``keys``, the sum with two decimals, the number of rows, and their mean with two decimals.

    ``partials`` has one row for each group and bin. The mean is over all rows, null amounts
    among them.
    """
    bins = F.collect_list(F.when(F.col("_bin").isNotNull() & (F.col("_units") != 0), F.struct("_bin", "_units")))
    plain = [F.sum(c).alias(c) for c in _SUMS if c != "_units"]
    df = partials.groupBy(*keys).agg(*plain, F.map_from_entries(bins).alias("_bins"))
    positions = "sequence(_lowest, greatest(array_max(map_keys(_bins)), -1) + 7)"
    value = f"coalesce(try_element_at(_bins, p), 0BD) + if(p = -1, {_EXACT} * {_BASE}BD, 0BD)"
    steps = {
        "_lowest": "if(size(_bins) > 0, least(array_min(map_keys(_bins)), -1), null)",
        "_signed": f"if(_lowest IS NULL, null, transform({positions}, p -> cast({value} AS decimal(38,0))))",
        "_first": f"if(_signed IS NULL, null, {_carried('_signed')})",
        "_minus": "_first.carry < 0",
        "_size": f"if(_minus, {_carried('transform(_signed, v -> cast(-v AS decimal(38,0)))')}, _first)",
        "_total": f"if(_size IS NULL, null, {_carried(_with_half_cent('_size.digits'))})",
    }
    if mean:
        steps["_by"] = f"if(_size IS NULL, null, reverse({_divided('_size.digits', '_rows')}))"
        steps["_mean"] = f"if(_by IS NULL, null, {_carried(_with_half_cent('_by'))})"
    for name, sql in steps.items():  # one by one, so that none is computed twice
        df = df.withColumn(name, F.expr(sql))
    nan, up, down = (F.col(c) > 0 for c in ("_nan", "_up", "_down"))
    beyond = F.when(nan | (up & down), float("nan")).when(up, float("inf")).when(down, float("-inf"))

    def result(cents: str, big: str) -> Column:
        value = F.when(F.col("_lowest").isNull(), F.expr(cents)).otherwise(F.expr(_to_double(big)))
        return F.when(F.col("_known") != 0, F.coalesce(beyond, value))

    columns = [result(_cents_by("1L"), "_total").alias(total)]
    if n:
        columns.append(F.col("_rows").alias(n))
    if mean:
        columns.append(result(_cents_by("_rows"), "_mean").alias(mean))
    return df.select(*keys, *columns)
