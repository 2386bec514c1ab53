"""Means that do not depend on the order in which rows are added.

A plain ``avg`` over doubles adds in whatever order tasks finish, so its last
digits, and with them a mean rounded to two places, may change between runs.
Here sums are exact, for every finite double: each value is taken apart into whole
numbers that 64-bit sums add without loss.

A value that is a whole number of millionths (one that reads so, as 0.1 does) counts as
that number of millionths. Any other counts as the binary fraction it is, in units that
depend on its size: values between ``2 ** (21 r)`` and ``2 ** (21 (r + 1))`` are whole
numbers of ``2 ** (21 r - 53)``. This ``range`` is a grouping key, so ordinary data, which
are on the grid of millionths, have one group as before, and others a few. NaN and the
infinities have ranges of their own, and give the mean that they would give in any order.

A value's whole number is kept as four digits of 21 bits, so each sum holds 10^12 rows. All
parts are plain sums and counts and merge: a coarse roll-up can be aggregated again and
gives the same mean as the raw rows. Only the last step, from the exact sums of a group to
one double, rounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skylattice.functions.columns import quoted

_DIGITS = ("d3", "d2", "d1", "d0")
_PARTS = (*_DIGITS, "count")
#: Ranges of values that are no numbers to add.
_NAN, _PLUS, _MINUS = 1_000, 1_001, 1_002


def mean_columns(value: str, prefix: str) -> dict[str, Column]:
    """Range, high and low part of each value, for :func:`mean_parts`."""
    x = quoted(value)
    # A long holds the millionths of what is smaller; larger doubles are whole numbers
    # anyway, for which both forms are exact.
    grid = f"case when abs({x}) < 4e12D then cast(rint({x} * 1e6D) as bigint) end"
    on_grid = f"coalesce({grid} / 1e6D = {x}, false)"
    power = f"cast(floor(log2(abs({x})) / 21) as int)"
    special = f"case when isnan({x}) then {_NAN} when {x} > 0 then {_PLUS} else {_MINUS} end"
    finite = f"abs({x}) < double('Infinity')"
    # Powers of two are exact; two of them, as one may be out of range.
    steps = f"(53 - 21 * ({power}))"
    whole = f"{x} * pow(2D, {steps} div 2) * pow(2D, {steps} - {steps} div 2)"
    high = f"floor(({whole}) / 4398046511104D)"
    low = f"({whole}) - {high} * 4398046511104D"
    return {
        f"{prefix}_range": F.expr(
            f"case when {x} is null or {on_grid} then null when {finite} then {power}"
            f" else {special} end"
        ),
        f"{prefix}_high": F.expr(
            f"case when {on_grid} then shiftright({grid}, 42)"
            f" when {finite} then cast({high} as bigint) end"
        ),
        f"{prefix}_low": F.expr(
            f"case when {on_grid} then ({grid}) & 4398046511103L"
            f" when {finite} then cast({low} as bigint) end"
        ),
        f"{prefix}_known": F.expr(f"{x} is not null"),
    }


def mean_ranges(*prefixes: str) -> list[str]:
    """Grouping keys that the parts of these means need."""
    return [f"{prefix}_range" for prefix in prefixes]


def mean_parts(prefix: str) -> list[Column]:
    """Aggregates over :func:`mean_columns`, grouped by :func:`mean_ranges` among others."""
    high, low = f"{prefix}_high", f"{prefix}_low"
    aggregate = {
        "d3": f"sum(shiftright({high}, 21))",
        "d2": f"sum({high} & 2097151L)",
        "d1": f"sum(shiftright({low}, 21))",
        "d0": f"sum({low} & 2097151L)",
        "count": f"count(if({prefix}_known, 1, null))",
    }
    return [F.expr(aggregate[part]).alias(f"{prefix}_{part}") for part in _PARTS]


def merge_mean_parts(prefix: str) -> list[Column]:
    """Aggregates that fold rows of parts into parts."""
    return [F.sum(f"{prefix}_{part}").alias(f"{prefix}_{part}") for part in _PARTS]


def gather_means(parts: DataFrame, keys: Sequence[str], prefixes: Sequence[str]) -> DataFrame:
    """One row for each key: the parts of all ranges, for :func:`mean_value`, and the counts.

    ``parts`` has one row for each key and combination of ranges, of which there are at most
    a hundred for a mean, however many rows went in.
    """
    aggregates = []
    for prefix in prefixes:
        digits = ", ".join(f"'{d}', {prefix}_{d}" for d in _DIGITS)
        entry = f"named_struct('range', {prefix}_range, {digits})"
        aggregates += [
            F.expr(f"collect_list(if({prefix}_count > 0, {entry}, null)) as {prefix}_sums"),
            F.expr(f"sum({prefix}_count) as {prefix}_count"),
        ]
    return parts.groupBy(*keys).agg(*aggregates)


def exact_means(df: DataFrame, keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """Sums by key of the columns in ``values`` (prefix to column), for :func:`mean_value`."""
    columns = {}
    for prefix, value in values.items():
        columns |= mean_columns(value, prefix)
    parts = df.withColumns(columns).groupBy(*keys, *mean_ranges(*values))
    sums = parts.agg(*(part for prefix in values for part in mean_parts(prefix)))
    return gather_means(sums, keys, list(values))


def mean_value(prefix: str, digits: int | None = 2) -> Column:
    """The mean as a double; rounded half-up unless ``digits`` is None."""
    count, sums = f"nullif({prefix}_count, 0)", f"{prefix}_sums"
    # 2097152 is 2 to the 21.
    shift = "cast(2097152 as decimal(7,0))"
    one = "cast(s.d3 as decimal(38,0))"
    for digit in _DIGITS[1:]:
        one = f"cast({one} * {shift} + s.{digit} as decimal(38,0))"
    total = (
        f"aggregate(filter({sums}, s -> s.range is null), cast(0 as decimal(38,0)),"
        f" (a, s) -> cast(a + {one} as decimal(38,0)))"
    )
    if digits is None:
        exact = f"cast({total} as double) / 1e6D / {count}"
    else:
        unit = 10**digits
        rows = f"cast({count} as decimal(16,0))"
        # Integer arithmetic: half of the divisor is added, then it is divided.
        steps = f"(abs({total}) * {2 * unit} + {rows} * 1000000) div ({rows} * 2000000)"
        exact = f"cast(sign({total}) as double) * cast({steps} as double) / {float(unit)}D"
    mixed = f"(cast({total} as double) / 1e6D / {count} + {_binary_mean(sums, count)})"
    if digits is not None:
        mixed = f"round({mixed}, {digits})"

    def holds(code: int) -> str:
        return f"exists({sums}, s -> s.range <=> {code})"

    return F.expr(
        f"case when not exists({sums}, s -> s.range is not null) then {exact}"
        f" when {holds(_NAN)} or ({holds(_PLUS)} and {holds(_MINUS)}) then double('NaN')"
        f" when {holds(_PLUS)} then double('Infinity')"
        f" when {holds(_MINUS)} then double('-Infinity')"
        f" else {mixed} end"
    )


def _binary_mean(sums: str, count: str) -> str:
    """SQL text: the part of a mean that comes from binary fractions.

    Digits of all ranges are added by place, carries are passed on from below so that
    no place can cancel a higher one, and the five leading digits are put together.
    """
    ranges = f"transform(filter({sums}, s -> s.range is not null), s -> s.range)"
    # Three places more take the carries of the highest digit.
    lowest, highest = f"array_min({ranges})", f"(array_max({ranges}) + 6)"
    place = "case p - s.range " + " ".join(
        f"when {i} then s.{digit}" for i, digit in enumerate(reversed(_DIGITS))
    ) + " else 0L end"
    added = (
        f"transform(sequence({lowest}, {highest}),"
        f" p -> aggregate({sums}, 0L, (a, s) -> a + {place}))"
    )
    carry = "shiftright(d + c.carry + 1048576L, 21)"
    digits = (
        f"aggregate({added}, named_struct('carry', 0L, 'digits', cast(array() as array<bigint>)),"
        f" (c, d) -> named_struct('carry', {carry}, 'digits',"
        f" concat(array(d + c.carry - shiftleft({carry}, 21)), c.digits)), c -> c.digits)"
    )
    # From here on the highest digit comes first.
    lead = "array_position(transform(x, d -> d <> 0), true)"
    used = f"slice(x, cast({lead} as int), 5)"
    number = f"aggregate({used}, 0D, (a, d) -> a * 2097152D + d)"
    step = f"(21 * (cast({highest} - {lead} + 2 as int) - size({used})) - 53)"
    scaled = (
        f"{number} / {count} * pow(2D, {step} div 2) * pow(2D, {step} - {step} div 2)"
    )
    body = f"if({lead} = 0, 0D, {scaled})"
    # A lambda over a one-element array names the digits once.
    return f"element_at(transform(array({digits}), x -> {body}), 1)"
