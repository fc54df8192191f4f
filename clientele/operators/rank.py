"""Exact global ranks and order statistics without a single-task sort.

For ranks, rows are range-partitioned on the sort columns, so each task sorts one slice.
The slices are frozen by a checkpoint before they are counted, because a
second evaluation could cut them elsewhere. Everything that depends on the
whole order is then one small number per slice.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.session import truncate

# Order statistics: error of a sketch as a share of the rows, and rows of a bracket that are sorted on the driver.
SKETCH_ACCURACY = 10_000
SORTED_ROWS = 20_000

_SLICE_BITS = 33  # monotonically_increasing_id keeps the row position below this bit


def _sorted_slices(df: DataFrame, *order: str) -> DataFrame:
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return truncate(placed.select(
        "*",
        F.spark_partition_id().alias("_slice"),
        F.monotonically_increasing_id().bitwiseAND((1 << _SLICE_BITS) - 1).alias("_position"),
    ))


def _slice_offsets(sizes: DataFrame, by: list[str], size: str) -> DataFrame:
    """Rows before each slice; one row per slice (and group), so it is small."""
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum(size).over(before), F.lit(0)))


def global_rank(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Add the 1-based position of each row in the order of ``order``.

    The columns must order the rows uniquely for a repeatable result.
    """
    slices = _sorted_slices(df, *order)
    sizes = slices.groupBy("_slice").agg(F.count("*").alias("_size")).withColumn("_all", F.lit(0))
    offsets = _slice_offsets(sizes, ["_all"], "_size").select("_slice", "_before")
    return (
        slices.join(F.broadcast(offsets), "_slice")  # at most one row per partition
        .withColumn(name, (F.col("_before") + F.col("_position") + 1).cast("long"))
        .drop("_slice", "_position", "_before")
    )


def quintile_cuts(df: DataFrame, id_col: str, metrics: list[str], reverse: tuple[str, ...] = ()) -> dict:
    """Rows on the quintile borders of the unique rank of each metric.

    Ties are ordered by ``id_col``. Returns ``{metric: [(value, id), ...]}``
    with the four border rows; ``quintile_score`` compares rows with them, so
    scoring needs neither a join nor a further shuffle. All metrics are ranked
    in one range partitioning of (metric, value, id).
    """
    floating = any(df.schema[m].dataType.typeName() in ("double", "float") for m in metrics)
    wide = "double" if floating else "decimal(38,6)"
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("metric"), F.col(m).cast(wide).alias("value")) for i, m in enumerate(metrics)
    ]))
    stacked = df.select(F.col(id_col).alias("id"), pairs.alias("p")).select("p.metric", "p.value", "id")
    slices = _sorted_slices(stacked.filter("value is not null"), "metric", "value", "id")
    sizes = slices.groupBy("_slice", "metric").agg(
        F.count("*").alias("size"), F.min("_position").alias("start")
    )
    # A slice can hold the end of one metric and the start of the next.
    offsets = _slice_offsets(sizes, ["metric"], "size")
    totals = {r.metric: r.n for r in sizes.groupBy("metric").agg(F.sum("size").alias("n")).collect()}
    wanted = None
    for i, m in enumerate(metrics):
        n = totals.get(i, 0)
        ranks = [s * (n - 1) // 5 + 1 for s in range(1, 5)] if n else []
        if m in reverse:
            ranks = [n + 1 - r for r in ranks]
        hit = (F.col("metric") == i) & F.col("rank").isin(ranks)
        wanted = hit if wanted is None else wanted | hit
    ranked = slices.join(F.broadcast(offsets), ["_slice", "metric"]).withColumn(
        "rank", F.col("_before") + F.col("_position") - F.col("start") + 1
    )
    found = ranked.filter(wanted).select("metric", "rank", "value", "id").collect()  # four rows per metric
    cuts = {}
    for i, m in enumerate(metrics):
        at = {r["rank"]: (r["value"], r["id"]) for r in found if r["metric"] == i}
        n = totals.get(i, 0)
        ranks = [s * (n - 1) // 5 + 1 for s in range(1, 5)] if n else []
        cuts[m] = [at[n + 1 - r if m in reverse else r] for r in ranks]
    return cuts


def quintile_score(metric: str, id_col: str, cuts: list, reverse: bool = False) -> Column:
    """Score 1..5 of a row from the border rows of ``quintile_cuts``."""
    value, key = F.col(metric), F.col(id_col)
    score = F.lit(1)
    for cut_value, cut_id in cuts:
        bound, bound_id = F.lit(cut_value), F.lit(cut_id)
        if reverse:
            passed = (value < bound) | ((value == bound) & (key < bound_id))
        else:
            passed = (value > bound) | ((value == bound) & (key > bound_id))
        score = score + F.when(passed, 1).otherwise(0)
    return F.when(value.isNotNull(), score).cast("int")


@dataclass(frozen=True)
class _Bracket:
    """The values of a column strictly between two bounds, and how many are not above the lower one."""

    column: str
    low: float | None
    high: float | None
    before: int
    inside: int

    def values(self) -> Column:
        v = F.col(self.column).cast("double")
        within = v.isNotNull()
        if self.low is not None:
            within = within & (v > F.lit(self.low))
        if self.high is not None:
            within = within & (v < F.lit(self.high))
        return F.when(within, v)


def order_statistics(df: DataFrame, ranks: dict[str, set[int]], counts: dict[str, int]) -> dict[tuple[str, int], float]:
    """The values at the 1-based ``ranks`` of each column, by counting selection.

    A sketch proposes two values around each rank and a count proves between
    which of them the rank lies; both passes are aggregates of all columns at
    once. A bracket shrinks to a few ten-thousandths per pass. What is left of it
    is collected and sorted when it has at most ``SORTED_ROWS`` rows. Nothing is
    sorted or shuffled but these, so every column keeps its place in the row.
    """
    places = {(c, k): _Bracket(c, None, None, 0, counts[c]) for c, wanted in ranks.items() for k in wanted}
    found: dict[tuple[str, int], float] = {}
    while wide := {b for b in places.values() if b.inside > SORTED_ROWS}:
        asked = {b: sorted({min(1.0, max(0.0, (k - b.before) / b.inside + side * 2 / SKETCH_ACCURACY))
                            for (_, k), at in places.items() if at == b for side in (-1, 1)}) for b in wide}
        order = list(asked)
        row = df.agg(*[F.percentile_approx(b.values(), asked[b], SKETCH_ACCURACY).alias(f"b{i}") for i, b in enumerate(order)]).first()
        cuts = {b: sorted(set(row[f"b{i}"])) for i, b in enumerate(order)}
        counted = []
        for i, b in enumerate(order):
            v = b.values()
            for j, cut in enumerate(cuts[b]):
                counted += [F.count_if(v < F.lit(cut)).alias(f"l{i}_{j}"), F.count_if(v == F.lit(cut)).alias(f"e{i}_{j}")]
        row = df.agg(*counted).first()
        for (c, k), b in list(places.items()):
            if b not in asked:
                continue
            i, low, before = order.index(b), b.low, b.before
            for j, cut in enumerate(cuts[b]):
                less, equal = b.before + row[f"l{i}_{j}"], row[f"e{i}_{j}"]
                if k <= less:  # between the cut before and this one
                    places[c, k] = _Bracket(c, low, cut, before, less - before)
                    break
                if k <= less + equal:
                    found[c, k] = cut
                    del places[c, k]
                    break
                low, before = cut, less + equal
            else:
                places[c, k] = _Bracket(c, low, b.high, before, b.before + b.inside - before)
    order = list(dict.fromkeys(places.values()))
    if order:
        row = df.agg(*[F.sort_array(F.collect_list(b.values())).alias(f"b{i}") for i, b in enumerate(order)]).first()
        sorted_ = {b: row[f"b{i}"] for i, b in enumerate(order)}  # at most SORTED_ROWS values each
        found |= {(c, k): sorted_[b][k - b.before - 1] for (c, k), b in places.items()}
    return found


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of several columns."""
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    ranks = {c: {r for p in probabilities for r in _neighbour_ranks(n, p)} for c, n in counts.items() if n}
    at = order_statistics(df, ranks, counts)
    result = {}
    for c, n in counts.items():
        values = []
        for p in probabilities if n else []:
            low, high = (at[c, k] for k in _neighbour_ranks(n, p))
            part = p * (n - 1) - math.floor(p * (n - 1))
            values.append(low if part == 0 else (1 - part) * low + part * high)
        result[c] = values or [None] * len(probabilities)
    return result


def _neighbour_ranks(n: int, p: float) -> tuple[int, int]:
    position = p * (n - 1)
    return math.floor(position) + 1, math.ceil(position) + 1
