"""Exact values at given ranks without sorting: a sketch proposes two values, counts show where the rank lies.

Each pass over a narrow (group, value) table counts, for all groups at once, the values below, at, between and above the two
proposals, and sketches the quantiles in between. Proposals are kept within the smallest and largest value left and every
count is exact, so a poor sketch costs a pass and never a wrong answer. When few enough values are left in every group, only those are grouped and counted off. Partial counts and sketches
are what is shuffled; a value that a third of all rows share is one count.

Null and undefined (NaN) values have no rank. Values are numbers, dates or timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.checks import require_columns, require_names, require_positive
from tagloom.operators.sizing import small_or_whole, staged

GRID = 256
ACCURACY = 10_000
#: Groups with at most this many values left are counted off value by value.
LAST = 1_000

_INSIDE = "(_a IS NULL OR _x > _a) AND (_b IS NULL OR _x < _b)"
_COUNTED = {
    "_c0": _INSIDE,
    "_c1": f"{_INSIDE} AND _x < _lo",
    "_c2": f"{_INSIDE} AND _x = _lo",
    "_c3": f"{_INSIDE} AND _x > _lo AND _x < _hi",
    "_c4": f"{_INSIDE} AND _x = _hi AND _hi > _lo",
}
_STEP = """CASE WHEN _lo IS NULL THEN 'fresh' WHEN _r <= _c1 THEN 'below' WHEN _r <= _c1 + _c2 THEN 'low'
  WHEN _r <= _c1 + _c2 + _c3 THEN 'between' WHEN _r <= _c1 + _c2 + _c3 + _c4 THEN 'high' ELSE 'above' END"""
_PROPOSED = "CASE WHEN _step = 'fresh' THEN _r / _c0 WHEN _step = 'between' THEN (_r - _c1 - _c2) / _c3 END"
_NEXT = {
    "_a": "CASE _step WHEN 'between' THEN _lo WHEN 'above' THEN _hi ELSE _a END",
    "_b": "CASE _step WHEN 'below' THEN _lo WHEN 'between' THEN _hi ELSE _b END",
    "_base": "_base + CASE _step WHEN 'between' THEN _c1 + _c2 WHEN 'above' THEN _c1 + _c2 + _c3 + _c4 ELSE 0 END",
    "_within": "CASE _step WHEN 'fresh' THEN _c0 WHEN 'below' THEN _c1 WHEN 'between' THEN _c3 ELSE _c0 - _c1 - _c2 - _c3 - _c4 END",
    "_lo": f"CASE WHEN _p IS NOT NULL THEN least(_max, greatest(_min, get(_grid, greatest(0, int(floor(_p * {GRID})) - 1)))) END",
    "_hi": f"CASE WHEN _p IS NOT NULL THEN greatest(_min, least(_max, get(_grid, least({GRID}, int(floor(_p * {GRID})) + 2)))) END",
    "_value": "CASE _step WHEN 'low' THEN _lo WHEN 'high' THEN _hi END",
    "_before": "CASE _step WHEN 'low' THEN _base + _c1 WHEN 'high' THEN _base + _c1 + _c2 + _c3 END",
    "_equal": "CASE _step WHEN 'low' THEN _c2 WHEN 'high' THEN _c4 END",
}


def nth_values(rows: DataFrame, ranks: DataFrame, group: str, value: str, *, last: int = LAST) -> DataFrame:
    """The value at a rank of each group, smallest first: group, ``rank``, ``value``, ``before`` and ``equal``.

    ``ranks`` has one row per group with its ``rank``, from 1. ``before`` counts smaller values and ``equal`` copies. Groups
    with fewer values than their rank are left out. Null is a group of its own.
    """
    require_positive(last=last)
    require_columns(rows, [group, value], "rows")
    require_columns(ranks, [group, "rank"], "ranks")
    kind = rows.select(F.col(value).alias("_x")).schema["_x"].dataType
    narrow = rows.select(F.col(group).alias("_g"), F.col(value).alias("_x")).filter(F.col("_x").isNotNull())
    if kind.typeName() in ("float", "double"):
        narrow = narrow.filter(~F.isnan("_x"))
    empty = F.lit(None).cast(kind)
    state = ranks.select(
        F.col(group).alias("_g"), F.col("rank").cast("bigint").alias("_rank"), F.lit(0).cast("bigint").alias("_base"),
        F.lit(None).cast("bigint").alias("_within"), *[empty.alias(c) for c in ("_a", "_b", "_lo", "_hi", "_value")],
        *[F.lit(None).cast("bigint").alias(c) for c in ("_before", "_equal")],
    )
    state = staged(state, "ranks")
    found, waiting = [], state
    while not waiting.isEmpty():
        state = staged(_narrowed(narrow, waiting), "ranks")
        found.append(state.filter("_value IS NOT NULL"))
        open_ = state.filter("_value IS NULL")
        found.append(_counted_off(narrow, open_.filter(F.col("_within") <= last)))
        waiting = open_.filter(F.col("_within") > last)
    columns = [F.col("_g").alias(group), *[F.col(f"_{c}").alias(c) for c in ("rank", "value", "before", "equal")]]
    if not found:
        return state.select(*columns)
    out = found[0].select(*columns)
    for part in found[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def _met(narrow: DataFrame, state: DataFrame, columns: list[str]) -> DataFrame:
    side = state.select(F.col("_g").alias("_k"), *columns)
    return narrow.join(small_or_whole(side), F.col("_g").eqNullSafe(F.col("_k"))).drop("_k").filter(_INSIDE)


def _narrowed(narrow: DataFrame, state: DataFrame) -> DataFrame:
    """One pass: the state of every group whose rank its values reach."""
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    between = F.expr("CASE WHEN _lo IS NULL OR (_x > _lo AND _x < _hi) THEN _x END")
    # sketches hold doubles: whole numbers are sketched by their distance from a known bound, which keeps large ones apart
    whole = isinstance(narrow.schema["_x"].dataType, T.IntegralType)
    sketched = F.try_subtract(between, F.expr("coalesce(_lo, _a, 0)")) if whole else between
    counts = _met(narrow, state, ["_a", "_b", "_lo", "_hi"]).groupBy("_g").agg(
        *[F.expr(f"count_if({rule})").alias(c) for c, rule in _COUNTED.items()],
        F.percentile_approx(sketched, grid, F.lit(ACCURACY)).alias("_grid"),
        F.min(between).alias("_min"),
        F.max(between).alias("_max"),
    )
    both = state.join(counts.withColumnRenamed("_g", "_k"), F.col("_g").eqNullSafe(F.col("_k"))).drop("_k")
    both = both.withColumn("_r", F.expr("_rank - _base")).filter("_r <= _c0")
    both = both.withColumn("_step", F.expr(_STEP)).withColumn("_p", F.expr(_PROPOSED))
    if whole:
        both = both.withColumn("_grid", F.expr("transform(_grid, x -> try_add(x, coalesce(_lo, _a, 0)))"))
    return both.select("_g", "_rank", *[F.expr(rule).cast(state.schema[c].dataType).alias(c) for c, rule in _NEXT.items()])


def _counted_off(narrow: DataFrame, state: DataFrame) -> DataFrame:
    values = _met(narrow, state, ["_a", "_b", "_base", "_rank"]).groupBy("_g", "_x", "_base", "_rank").agg(F.count(F.lit(1)).alias("_equal"))
    so_far = F.sum("_equal").over(Window.partitionBy("_g").orderBy("_x"))
    placed = values.withColumn("_before", F.col("_base") + so_far - F.col("_equal"))
    hit = placed.filter("_before < _rank AND _rank <= _before + _equal")
    return hit.select("_g", "_rank", F.col("_x").alias("_value"), "_before", "_equal")


def top_n_selected(rows: DataFrame, group: str, n: int, score: str, key: str, *, last: int = LAST) -> DataFrame:
    """The ``n`` rows of each group with the highest scores, equal scores by the smaller key; smaller groups whole.

    Only cut-off values are looked for, rows are filtered where they lie. Rows without a score or key are not kept. ``key``
    must be a number, date or timestamp and unique: two rows that tie in score and key at a cut-off are an error.
    """
    require_positive(n=n)
    require_names(group=group, score=score, key=key)
    require_columns(rows, [group, score, key], "rows")
    low = -F.col(score).cast("double")
    sound = low.isNotNull() & ~F.isnan(low) & F.col(key).isNotNull()
    narrow = rows.filter(sound).select(F.col(group).alias("_group"), low.alias("_low"), F.col(key).alias("_key"))
    sizes = narrow.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    ranks = staged(sizes.filter(F.col("_size") > n).select("_group", F.lit(n).alias("rank")), "ranks")
    cuts = nth_values(narrow, ranks, "_group", "_low", last=last)
    cuts = cuts.select("_group", F.col("value").alias("_cut"), (n - F.col("before")).alias("_left"), "equal")
    cuts = staged(cuts, "cuts")
    torn = small_or_whole(cuts.filter("equal > _left").select(F.col("_group").alias("_torn"), "_cut", F.col("_left").alias("rank")))
    ties = narrow.join(torn, F.col("_group").eqNullSafe(F.col("_torn")) & (F.col("_low") == F.col("_cut")))
    keys = nth_values(ties, torn.withColumnRenamed("_torn", "_group"), "_group", "_key", last=last)
    keys = staged(keys.select(F.col("_group").alias("_of"), F.col("value").alias("_last_key"), "before", "equal", "rank"), "keys")
    if not keys.filter("before + equal > rank").isEmpty():
        raise ValueError(f"rows tie in {score} and {key} at a cut-off")
    whole = cuts.join(keys.select("_of", "_last_key"), F.col("_group").eqNullSafe(F.col("_of")), "left").drop("_of")
    whole = small_or_whole(whole.select("_group", "_cut", "_last_key", F.lit(True).alias("_judged")))
    met = rows.filter(sound).join(whole, F.col(group).eqNullSafe(F.col("_group")), "left")
    inside = (low < F.col("_cut")) | ((low == F.col("_cut")) & (F.col("_last_key").isNull() | (F.col(key) <= F.col("_last_key"))))
    return met.filter(F.col("_judged").isNull() | inside).select(*[F.col(f"`{c}`") for c in rows.columns])
