"""Exact positions, running totals and quantiles over a global order.

A window without partition keys moves every row to one task, and a window over a hot key moves
that key's rows to one task. Where every row needs its place, Spark's range-partitioned sort spreads the rows by the full
sort key (which must be unique), the sorted rows are checkpointed once, and what each partition
has to add for the rows before it comes from a table with one row per partition. That table is
the only thing broadcast, so the broadcast is bounded by the number of sort partitions. Rows in the order of a
uniform hash need no sort: a hash's first digits say which bin a row is in.

Where only a few places of an order matter (quantiles, tiles, splits, a top share), nothing is sorted or moved:
the values at those places are found by counting (`order_statistics`, `cuts`), and a row then compares itself
with them.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from shoplayers.session import durable

# Layout of monotonically_increasing_id(): partition number above bit 33, row number below it.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1
# Bins that a bracket of values is cut into by one counting pass.
BINS = 4096
# Values per level of a quantile sketch, the steps its estimates are taken at, and the share of rows that a bracket
# reaches beyond them, some four times the sketch's error. A bracket that misses its place is replaced by the whole range.
SKETCH_SIZE = 4096
STEPS = 100
SKETCH_MARGIN = 0.003
# Different values that the driver takes to finish a search.
LAST_VALUES = 20_000
_LARGEST = sys.float_info.max


def _sorted_with_parts(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    rows = durable(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()))
    return rows.withColumn("_part", F.shiftright("_row", _ROW_BITS))


def with_stratum_position(
    df: DataFrame,
    strata: str,
    order: Sequence[Column | str],
    name: str = "position",
    size: str = "stratum_size",
) -> DataFrame:
    """Add the 1-based position inside each stratum and the stratum's size.

    For a column with a fixed small set of values (labels, bands, dimensions); a stratum may hold
    any share of the rows. The rows of a stratum are contiguous in the sort, so the broadcast table
    has at most one row per partition and stratum edge. Use `with_running_totals` when the number
    of groups grows with the data.
    """
    rows = _sorted_with_parts(df, [strata, *order])
    pieces = rows.groupBy(F.col("_part").alias("_piece_part"), F.col(strata).alias("_stratum")).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    stratum = W.partitionBy("_stratum")
    earlier = stratum.orderBy("_piece_part").rowsBetween(W.unboundedPreceding, -1)
    edges = pieces.select(
        "_piece_part",
        "_stratum",
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(stratum).alias(size),
    )
    same_piece = (F.col("_part") == F.col("_piece_part")) & F.col(strata).eqNullSafe(F.col("_stratum"))
    return (
        rows.join(F.broadcast(edges), same_piece)
        .withColumn(name, F.col("_before") + F.col("_row") - F.col("_first") + 1)
        .drop("_row", "_part", "_piece_part", "_stratum", "_first", "_before")
    )


def with_running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column | str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Add inclusive running sums of `totals` per group, in `order`.

    A group of any size may span many partitions; each partition sums its own rows and adds what
    earlier partitions of the same group hold. Only the first group of a partition can have such
    a carry, so the broadcast carry table has at most one row per partition.
    """
    rows = _sorted_with_parts(df, [*groups, *order])
    spanning = rows
    if groups:
        # Only a partition's first group can reach back; keep the rows of such groups.
        first = rows.filter(F.col("_row").bitwiseAND(F.lit(_ROW_MASK)) == 0)
        first = first.select(*[F.col(g).alias(f"_first_{g}") for g in groups])
        same_group = [F.col(g).eqNullSafe(F.col(f"_first_{g}")) for g in groups]
        spanning = rows.join(F.broadcast(first), reduce(Column.__and__, same_group), "left_semi")
    pieces = spanning.groupBy("_part", *groups).agg(
        *[F.sum(value).alias(f"_sum_{name}") for name, value in totals.items()]
    )
    earlier = W.partitionBy(*groups).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carries = (
        pieces.withColumn("_pieces_before", F.count(F.lit(1)).over(earlier))
        .select(
            F.col("_part").alias("_carry_part"),
            *[F.col(g).alias(f"_carry_{g}") for g in groups],
            *[F.sum(f"_sum_{name}").over(earlier).alias(f"_carry_sum_{name}") for name in totals],
            "_pieces_before",
        )
        .filter("_pieces_before > 0")
        .drop("_pieces_before")
    )
    same = [F.col("_part") == F.col("_carry_part")]
    same += [F.col(g).eqNullSafe(F.col(f"_carry_{g}")) for g in groups]
    inside = (
        W.partitionBy("_part", *groups).orderBy("_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    joined = rows.join(F.broadcast(carries), reduce(Column.__and__, same), "left")
    for name, value in totals.items():
        carry = F.col(f"_carry_sum_{name}")
        joined = joined.withColumn(
            name, F.sum(value).over(inside) + F.coalesce(carry, F.lit(0).cast("long"))
        )
    return joined.drop(
        "_row", "_part", "_carry_part", *[f"_carry_{g}" for g in groups], *[f"_carry_sum_{n}" for n in totals]
    )


def with_running_number(
    df: DataFrame, groups: Sequence[str], order: str, name: str, sizes: DataFrame, pieces: int = 1000
) -> DataFrame:
    """Number the rows of each group from 1 in the order of a whole-number column, in one shuffle.

    `sizes` has one row per group with `n` rows and the extremes `first` and `last` of the order column.
    A group with at least 1/`pieces` of all rows is cut into stretches of the order column, each numbered
    on its own; what the stretches before it hold is added. At most `pieces` groups are cut, into at most
    twice as many stretches, which bounds both broadcast tables.
    """
    total = sizes.agg(F.sum("n")).scalar()
    cuts = F.ceil(F.col("n") * pieces / total).cast("long")
    hot = sizes.filter((F.col("n") * pieces >= total) & (cuts > 1)).select(
        *[F.col(g).alias(f"_hot_{g}") for g in groups], "first", "last", cuts.alias("_cuts")
    )
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"_hot_{g}")) for g in groups])
    reach = (F.col(order) - F.col("first")).cast("double") / (F.col("last") - F.col("first") + 1)
    stretch = F.coalesce(F.floor(reach * F.col("_cuts")), F.lit(0)).cast("long")
    cut = df.join(F.broadcast(hot), same, "left").withColumn("_stretch", stretch)
    keys = [*groups, "_stretch"]
    counts = cut.filter("_cuts IS NOT NULL").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*groups).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(
        *[F.col(k).alias(f"_before_{k}") for k in keys], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    numbered = cut.withColumn("_number", F.row_number().over(W.partitionBy(*keys).orderBy(order)).cast("long"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_before_{k}")) for k in keys])
    joined = numbered.join(F.broadcast(before), same, "left")
    return joined.select(*df.columns, (F.col("_number") + F.coalesce("_before", F.lit(0))).alias(name))


def tile(position: Column, size: Column, tiles: int) -> Column:
    """NTILE from a 1-based position: the first `size % tiles` tiles hold one row more."""
    small = F.floor(size / F.lit(tiles))
    longer = size % F.lit(tiles)
    edge = longer * (small + 1)
    in_longer = F.floor((position - 1) / (small + 1)) + 1
    in_shorter = longer + F.floor((position - edge - 1) / F.greatest(small, F.lit(1).cast("long"))) + 1
    return F.when(position <= edge, in_longer).otherwise(in_shorter).cast("int")


@dataclass
class Statistic:
    """The value at a place of a column's order, the rows below it and the rows that have it."""

    value: float
    below: int
    equal: int


@dataclass
class _Search:
    """A place wanted in a column's order, the bracket it is looked for in, and what is known of that."""

    column: str
    place: int
    low: float
    high: float
    whole: tuple[float, float]
    below: int | None = None  # rows below the bracket
    rows: int | None = None  # rows in the bracket
    values: int | None = None  # at most so many different values in the bracket
    found: Statistic | None = None

    @property
    def bracket(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high


def sortable(column: Column) -> Column:
    """A number as a double that keeps Spark's ascending order: NULL first, NaN last."""
    value = F.greatest(F.lit(-_LARGEST), F.least(column.cast("double"), F.lit(_LARGEST)))
    return F.when(column.isNull(), F.lit(-_LARGEST)).otherwise(value)


def _cells(searches: Sequence[_Search], cell: Callable[[int, Column, float, float], Column]) -> tuple[list, Column]:
    """The brackets of the searches, and for a row one cell for every bracket it is counted for."""
    brackets = sorted({s.bracket for s in searches})
    made = [cell(number, F.col(column), low, high) for number, (column, low, high) in enumerate(brackets)]
    return brackets, F.explode(F.filter(F.array(*made), lambda c: c.isNotNull())).alias("c")


def _count_bins(values: DataFrame, searches: Sequence[_Search]) -> None:
    """One pass: count the rows below and in BINS bins of every bracket, and go on in the bin that holds the place.

    A task sends at most BINS + 1 rows a bracket, the driver gets one row a search.
    """

    def cell(number: int, value: Column, low: float, high: float) -> Column:
        # Halves, so no difference overflows, unless they are too small to differ.
        half = 2 if high / 2 > low / 2 else 1
        share = (value / half - F.lit(low / half)) / F.lit(high / half - low / half)
        place = F.when(value < low, F.lit(-1)).otherwise(F.least(F.floor(share * BINS), F.lit(BINS - 1))).cast("int")
        made = F.struct(F.lit(number).alias("bracket"), place.alias("bin"), value.alias("value"))
        return F.when(value <= high, made)

    brackets, cells = _cells(searches, cell)
    binned = values.select("_weight", cells).groupBy("c.bracket", "c.bin")
    binned = binned.agg(F.sum("_weight").alias("n"), F.min("c.value").alias("low"), F.max("c.value").alias("high"))
    upto = F.sum("n").over(W.partitionBy("bracket").orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow))
    counted = binned.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    wanted = F.lit(False)
    for number, bracket in enumerate(brackets):
        for search in searches:
            if search.bracket == bracket:
                holds = (F.col("before") <= search.place) & (F.col("upto") > search.place)
                wanted |= (F.col("bracket") == number) & holds
    rows = [row.asDict() | {"key": brackets[row["bracket"]]} for row in counted.filter(wanted).collect()]
    for search in searches:
        held = [r for r in rows if r["key"] == search.bracket and r["before"] <= search.place < r["upto"]]
        if not held or held[0]["bin"] < 0:  # the place is beyond a bracket that was estimated
            search.low, search.high = search.whole
            search.below = search.rows = None
            continue
        search.low, search.high = held[0]["low"], held[0]["high"]
        search.below, search.rows = held[0]["before"], held[0]["n"]
        if search.low == search.high:
            search.found = Statistic(search.low, search.below, search.rows)


def _count_values(values: DataFrame, searches: Sequence[_Search]) -> None:
    """One pass: the different values of brackets that hold few rows come to the driver with their counts."""

    def cell(number: int, value: Column, low: float, high: float) -> Column:
        made = F.struct(F.lit(number).alias("bracket"), value.alias("value"))
        return F.when((value >= low) & (value <= high), made)

    brackets, cells = _cells(searches, cell)
    counted = values.select("_weight", cells).groupBy("c.bracket", "c.value").agg(F.sum("_weight").alias("n"))
    found: dict = {bracket: [] for bracket in brackets}
    for row in counted.collect():  # LAST_VALUES rows at most
        found[brackets[row["bracket"]]].append((row["value"], row["n"]))
    for search in searches:
        below = search.below
        for value, n in sorted(found[search.bracket]):
            if below + n > search.place:
                search.found = Statistic(value, below, n)
                break
            below += n


def order_statistics(
    df: DataFrame,
    columns: Mapping[str, Column],
    wanted: Callable[[str, int], Iterable[int]],
    weight: Column | None = None,
) -> tuple[dict[str, int], dict[tuple[str, int], Statistic]]:
    """Rows per column, and the exact values at wanted places (from 0) of each column's ascending order.

    `wanted` gets a column's name and its number of rows; rows where a column is NULL don't count for it.
    The first pass brings the number of rows, the extremes and a mergeable quantile sketch of every column,
    whose estimates bracket the wanted places. The second counts the rows below and in BINS bins of each
    bracket. The third gets the different values of the bins that hold the places. Only where such a bin
    holds more than LAST_VALUES rows, or an estimate was wrong, bins are counted again. No value is sorted or shuffled.
    `weight` says how many rows a row stands for (there is no sketch then). `df` is read once a pass:
    a plan that is dear to run is better stored before.
    """
    rows_of = F.lit(1).cast("long") if weight is None else weight.cast("long")
    values = df.select(*[value.cast("double").alias(name) for name, value in columns.items()], rows_of.alias("_weight"))
    basics = [
        F.struct(
            F.sum(F.when(F.col(c).isNotNull(), F.col("_weight"))).alias("n"),
            F.min(c).alias("low"),
            F.max(c).alias("high"),
            (F.lit(None) if weight is not None else F.kll_sketch_agg_double(c, SKETCH_SIZE)).alias("sketch"),
        ).alias(c)
        for c in columns
    ]
    first = values.agg(*basics)
    if weight is None:  # estimates at equal steps of every column
        steps = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
        estimates = [F.when(F.col(c)["n"] > 0, F.kll_sketch_get_quantile_double(F.col(c)["sketch"], steps)).alias(f"_{c}") for c in columns]
        first = first.select(*[F.col(c).dropFields("sketch").alias(c) for c in columns], *estimates)
    row = first.first()
    counts = {c: row[c]["n"] or 0 for c in columns}
    searches: list[_Search] = []
    for c, n in counts.items():
        for place in sorted({p for p in wanted(c, n) if 0 <= p < n}):
            low, high = whole = row[c]["low"], row[c]["high"]
            search = _Search(c, place, low, high, whole)
            searches.append(search)
            if low == high:
                search.found = Statistic(low, 0, n)
            elif weight is None:
                share = place / n
                lower, upper = math.floor((share - SKETCH_MARGIN) * STEPS), math.ceil((share + SKETCH_MARGIN) * STEPS)
                search.low = row[f"_{c}"][min(lower, STEPS)] if lower >= 0 else low
                search.high = row[f"_{c}"][max(upper, 0)] if upper <= STEPS else high
                if search.low == search.high:  # a bracket needs a width; one value may hold many rows
                    search.high = math.nextafter(search.high, math.inf)
    while open_ := [s for s in searches if not s.found]:
        few, sizes = [], {}
        for s in open_:
            if s.rows is not None and s.rows <= LAST_VALUES:
                sizes[s.bracket] = s.rows
                if sum(sizes.values()) <= LAST_VALUES:
                    few.append(s)
        if few:
            _count_values(values, few)
        if many := [s for s in open_ if s not in few]:
            _count_bins(values, many)
    return counts, {(s.column, s.place): s.found for s in searches}


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], weight: Column | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per column, one output `q<i>` per probability.

    NULL and NaN don't count, infinities count as the largest numbers. `weight` says how many rows a row
    stands for. The jobs run when this is called (`order_statistics`).
    """

    def finite(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(value.isNotNull() & ~F.isnan(value), F.greatest(F.lit(-_LARGEST), F.least(value, F.lit(_LARGEST))))

    def edges(p: float, n: int) -> tuple[int, int]:
        return math.floor(float(p) * (n - 1)), math.ceil(float(p) * (n - 1))

    counts, found = order_statistics(
        df, {c: finite(c) for c in columns}, lambda c, n: [place for p in probabilities for place in edges(p, n)], weight
    )

    def quantile(c: str, p: float) -> float:
        low, high = edges(p, counts[c])
        exact = float(p) * (counts[c] - 1)
        below, above = found[c, low].value, found[c, high].value
        return below + (above - below) * (exact - low)

    rows = [(c, *[quantile(c, p) for p in probabilities]) for c in columns if counts[c]]
    names = ", ".join(f"q{i} double" for i in range(len(probabilities)))
    return df.sparkSession.createDataFrame(rows, f"column_name string, {names}")


def exact_quantile(df: DataFrame, column: str, probability: float, weight: Column | None = None) -> Column:
    """One exact quantile as a constant; NULL for a column without values."""
    row = exact_quantiles(df, [column], [probability], weight).first()
    return F.lit(row["q0"] if row else None).cast("double")


# --- cutting an order at a few places --------------------------------------------------------------


def levels(df: DataFrame, column: str) -> list[Column]:
    """Sort columns that keep the exact order of a number column of `df`: the nearest double, then what it leaves."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return [value.cast("double")]
    if isinstance(kind, T.DecimalType):
        near = value.cast("double")
        return [near, (value - near.cast(kind)).cast("double")]
    if isinstance(kind, T.IntegralType):
        near = value.cast("double")
        return [near, (value.cast("decimal(20,0)") - near.cast("decimal(20,0)")).cast("double")]
    raise TypeError(f"{column} is no number: {kind.simpleString()}")


@dataclass(frozen=True)
class Order:
    """An ascending order of the rows with `when` (all rows without it) by several numbers."""

    by: Sequence[Column]
    when: Column | None = None

    def inside(self) -> Column:
        return F.lit(True) if self.when is None else F.coalesce(self.when, F.lit(False))

    def reaches(self, cut: Sequence[float]) -> Column:
        """Whether a row comes at the cut or before it."""
        reached = F.lit(True)
        for number, value in reversed(list(zip(self.by, cut))):
            own = sortable(number)
            reached = (own < F.lit(value)) | ((own == F.lit(value)) & reached)
        return reached


def cuts(
    df: DataFrame, orders: Mapping[str, Order], wanted: Callable[[str, int], Iterable[int]]
) -> tuple[dict[str, int], dict[tuple[str, int], tuple[float, ...]]]:
    """Rows per order, and the sort values of the rows at wanted places (from 0): (order, place) -> cut.

    Only rows that tie at a cut are looked at again, by their next sort column.
    """
    columns = {name: F.when(order.inside(), sortable(order.by[0])) for name, order in orders.items()}
    places: dict[str, list[int]] = {}

    def remembered(name: str, n: int) -> list[int]:
        places[name] = sorted({p for p in wanted(name, n) if 0 <= p < n})
        return places[name]

    counts, found = order_statistics(df, columns, remembered)
    known = {key: ((stat.value,), key[1] - stat.below, stat.equal) for key, stat in found.items()}
    while open_ := {k: v for k, v in known.items() if v[2] > 1 and len(v[0]) < len(orders[k[0]].by)}:
        ties = sorted({(name, cut) for (name, _), (cut, _, _) in open_.items()})
        columns = {}
        for number, (name, cut) in enumerate(ties):
            order = orders[name]
            tied = order.inside()
            for value, at in zip(order.by, cut):
                tied &= sortable(value) == F.lit(at)
            columns[f"tie{number}"] = F.when(tied, sortable(order.by[len(cut)]))
        asked: dict[str, list[int]] = {}
        for key, (cut, place, _) in open_.items():
            asked.setdefault(f"tie{ties.index((key[0], cut))}", []).append(place)
        _, deeper = order_statistics(df, columns, lambda c, n: asked[c])
        for key, (cut, place, _) in open_.items():
            stat = deeper[f"tie{ties.index((key[0], cut))}", place]
            known[key] = ((*cut, stat.value), place - stat.below, stat.equal)
    return counts, {key: cut for key, (cut, _, _) in known.items()}


def tile_ends(rows: int, tiles: int) -> list[int]:
    """Last places (from 0) of all tiles but the last, where a row follows: the first `rows % tiles` hold one more."""
    small, longer = divmod(rows, tiles)
    ends = [small * (t + 1) + min(longer, t + 1) for t in range(tiles - 1)]
    return [end - 1 for end in ends if 0 < end < rows]


def tiles_of(df: DataFrame, orders: Mapping[str, Order], tiles: int) -> dict[str, Column]:
    """NTILE in each order as a column of `df`; rows outside an order get NULL."""
    counts, found = cuts(df, orders, lambda _, n: tile_ends(n, tiles))
    columns = {}
    for name, order in orders.items():
        number = F.lit(1)
        for end in tile_ends(counts[name], tiles):
            number = number + F.when(order.reaches(found[name, end]), F.lit(0)).otherwise(F.lit(1))
        columns[name] = F.when(order.inside(), number).cast("int")
    return columns


def with_hashed_position(
    df: DataFrame, strata: str, draw: str, key: str, name: str = "position", draw_bits: int = 60, bin_bits: int = 12
) -> DataFrame:
    """Add the 1-based position inside each stratum in the order of `draw`, a hash of `draw_bits` bits, then `key`.

    A hash is spread evenly, so its first `bin_bits` cut every stratum into bins of like size; rows are
    numbered inside their bin and add the rows of the bins before. One hash shuffle, no sampling and no sort
    of the table; the broadcast table has 2^bin_bits rows a stratum, of which there must be few.
    """
    rows = df.withColumn("_bin", F.shiftright(draw, draw_bits - bin_bits))
    sizes = rows.groupBy(F.col(strata).alias("_stratum"), F.col("_bin").alias("_of_bin")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy("_stratum").orderBy("_of_bin").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("_stratum", "_of_bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_number", F.row_number().over(W.partitionBy(strata, "_bin").orderBy(draw, key)).cast("long"))
    same = F.col(strata).eqNullSafe(F.col("_stratum")) & (F.col("_bin") == F.col("_of_bin"))
    placed = numbered.join(F.broadcast(before), same)
    return placed.withColumn(name, F.col("_number") + F.col("_before")).drop("_bin", "_stratum", "_of_bin", "_before", "_number")
