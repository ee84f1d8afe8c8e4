"""Exact quantiles of many columns and groups by counting, without a sort of a whole group.

Values are told apart by digits that keep their order. The first digit is the logarithm's, with the sign: one scan counts the values
per (group, column, digit), partial sums first, and running sums over these few rows tell the digit, and so the bracket
[least, greatest value], that holds each wanted rank. Brackets with many rows are cut again, by the place between their ends; brackets with few rows,
or of one value, are settled by counting their values. Every scan serves all groups, columns and ranks together, and what it looks up
is a table, not code: 200 columns or 5 000 groups take as many scans as one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opspark.session import bounded_broadcast, cut_lineage

#: First digits to a factor of two.
FINE = 64

#: Most rows of a bracket whose values are counted one by one.
LIMIT = 100_000

#: Counted digits that the driver looks through, where there are no groups.
FEW = 200_000

#: Places that a scan may count in all, and per bracket.
PLACES = 1 << 21
MOST_PLACES = 1 << 16


def _first_digit(v: Column) -> Column:
    """A whole number that does not fall as ``v`` grows; zero for zero, NaN above all."""
    size = F.floor(F.least(F.ln(F.abs(v)), F.lit(2000.0)) * F.lit(FINE / 0.6931471805599453)).cast("int") + 100_000
    return F.when(F.isnan(v), 10_000_000).when(v == 0, 0).when(v > 0, size).otherwise(-size)


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[f"_{n}"]) for n in names])


def _tall(df: DataFrame, keys: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """Rows (g0, g1, .., i, v) of all values that are there; the keys are renamed, so that they may have any name."""
    named = [F.col(k).alias(f"g{j}") for j, k in enumerate(keys)]
    cells = [F.struct(F.lit(i).alias("i"), v.cast("double").alias("v")) for i, v in enumerate(values)]
    rows = df.select(*named, F.explode(F.array(*cells)).alias("c")) if len(cells) > 1 else df.select(*named, cells[0].alias("c"))
    # one zero: -0.0 is 0.0
    return rows.select(*(f"g{j}" for j in range(len(keys))), "c.i", (F.col("c.v") + 0.0).alias("v")).where("v is not null")


def _before(cells: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """``before``: rows in the cells ahead."""
    ahead = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return cells.withColumn("before", F.coalesce(F.sum("c").over(ahead), F.lit(0)))


def _within(rows: DataFrame, brackets: DataFrame, group: Sequence[str], small: bool = False) -> DataFrame:
    """The rows inside a bracket (group, lo, hi), with it. Brackets of a group do not overlap."""
    named = brackets.toDF(*[f"_{n}" for n in brackets.columns])
    lo, hi = named["_lo"], named["_hi"]
    return rows.join(F.broadcast(named) if small else bounded_broadcast(named), _same(rows, named, group) & (rows["v"] >= lo) & (rows["v"] <= hi)).select(*rows.columns, lo.alias("lo"), hi.alias("hi"))


def _flat_statistics(rows: DataFrame, probs: Sequence[float], limit: int) -> list[tuple] | None:
    """(i, n, k, value) without groups: the counted digits are few and are looked through here, so that a scan is one job.

    None where there are more digits than ``FEW``.
    """
    spark = rows.sparkSession
    span = [F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    cells = rows.groupBy("i", _first_digit(F.col("v")).alias("digit")).agg(*span).limit(FEW + 1).collect()
    if len(cells) > FEW:
        return None

    def held(cells, asked: dict) -> list[tuple]:
        """(i, n, k, lo, hi, before, c) of the asked ranks; ``asked`` has by (i, bracket) the rows ahead, n and the ranks."""
        out, ahead = [], {}
        for i, of, _, c, lo, hi in sorted(cells, key=lambda r: r[:3]):
            start, n, ranks = asked[i, of]
            before = ahead.setdefault((i, of), start)
            out += [(i, n, k, lo, hi, before, c) for k in ranks if before <= k < before + c]
            ahead[i, of] = before + c
        return out

    totals: dict[int, int] = {}
    for r in cells:
        totals[r["i"]] = totals.get(r["i"], 0) + r["c"]
    asked = {(i, None): (0, n, sorted({k for p in probs for k in (int(p * (n - 1)), min(int(p * (n - 1)) + 1, n - 1))})) for i, n in totals.items()}
    wanted = held([(r["i"], None, r["digit"], r["c"], r["lo"], r["hi"]) for r in cells], asked)
    while crowd := [w for w in wanted if w[6] > limit and w[3] < w[4]]:
        asked = {}
        for i, n, k, lo, hi, before, _ in crowd:
            asked.setdefault((i, lo), (before, n, []))[2].append(k)
        brackets = sorted({(w[0], w[3], w[4]) for w in crowd})
        places = max(16, min(MOST_PLACES, FEW // len(brackets)))
        inside = _within(rows, spark.createDataFrame(brackets, "i int, lo double, hi double"), ["i"], True)
        digit = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * places), F.lit(places - 1))
        cut = inside.groupBy("i", F.col("lo").alias("of"), digit.alias("digit")).agg(*span).collect()
        wanted = [w for w in wanted if not (w[6] > limit and w[3] < w[4])] + held([tuple(r) for r in cut], asked)
    found = [(i, n, k, lo) for i, n, k, lo, hi, _, _ in wanted if not lo < hi]
    ready = [w for w in wanted if w[3] < w[4]]
    if ready:
        inside = _within(rows, spark.createDataFrame(sorted({(w[0], w[3], w[4]) for w in ready}), "i int, lo double, hi double"), ["i"], True)
        counted = _before(inside.groupBy("i", "lo", "v").agg(F.count("*").alias("c")), ["i", "lo"], "v").withColumnsRenamed({"i": "_i", "lo": "_lo"})
        places = spark.createDataFrame([(i, lo, n, k, k - before) for i, n, k, lo, _, before, _ in ready], "i int, lo double, n long, k long, place long")
        fits = (F.col("i") == F.col("_i")) & (F.col("lo") == F.col("_lo")) & (F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("c"))
        found += [tuple(r) for r in counted.join(F.broadcast(places), fits).select("i", "n", "k", "v").collect()]
    return found


def order_statistics(df: DataFrame, keys: Sequence[str], values: Sequence[Column], probs: Sequence[float], limit: int = LIMIT) -> DataFrame:
    """(g0, g1, .., i, n, k, value): the values at the ranks around each quantile, 0 for the smallest, of each group and column.

    ``g0`` and so on are the keys. ``n`` counts the values that are there; a group without any has no row. NaN is above all numbers.
    """
    group = [*(f"g{j}" for j in range(len(keys))), "i"]
    rows = _tall(df, keys, values)
    span = [F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    cells = cut_lineage(rows.groupBy(*group, _first_digit(F.col("v")).alias("digit")).agg(*span))
    placed = _before(cells, group, "digit").withColumn("n", F.sum("c").over(W.partitionBy(*group)))
    low = [F.floor(F.lit(p) * (F.col("n") - 1)) for p in probs]
    ranks = F.array_distinct(F.array(*[x for r in low for x in (r, F.least(r + 1, F.col("n") - 1))]))
    held = F.filter(ranks, lambda k: (k >= F.col("before")) & (k < F.col("before") + F.col("c")))
    wanted = cut_lineage(placed.select(*group, "n", F.explode(held).alias("k"), "lo", "hi", "before", "c"))
    crowded = (F.col("c") > limit) & (F.col("lo") < F.col("hi"))
    while True:
        many = wanted.where(crowded).select(*group, "lo").distinct().count()
        if not many:
            break
        places = max(16, min(MOST_PLACES, PLACES // many))
        brackets = wanted.where(crowded).select(*group, "lo", "hi").distinct()
        inside = _within(rows, brackets, group)
        # ends may be infinite only together with few values, as the first digit parts them from all others
        digit = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * places), F.lit(places - 1))
        cut = inside.groupBy(*group, F.col("lo").alias("of"), digit.alias("digit")).agg(*span)
        cut = _before(cut, [*group, "of"], "digit")
        cut = cut.toDF(*[f"_{n}" for n in cut.columns])
        asked = wanted.where(crowded)
        fits = _same(asked, cut, group) & (asked["lo"] == cut["_of"])
        found = asked.join(cut, fits & (asked["k"] - asked["before"] >= cut["_before"]) & (asked["k"] - asked["before"] < cut["_before"] + cut["_c"]))
        found = found.select(*group, "n", "k", cut["_lo"].alias("lo"), cut["_hi"].alias("hi"), (asked["before"] + cut["_before"]).alias("before"), cut["_c"].alias("c"))
        wanted = cut_lineage(wanted.where(~crowded).unionByName(found))
    one = F.col("lo") == F.col("hi")
    settled = wanted.where(one).select(*group, "n", "k", F.col("lo").alias("value"))
    open_ranks = wanted.where(~one)
    if open_ranks.isEmpty():
        return settled
    inside = _within(rows, open_ranks.select(*group, "lo", "hi").distinct(), group)
    counted = _before(inside.groupBy(*group, "lo", "v").agg(F.count("*").alias("c")), [*group, "lo"], "v")
    counted = counted.toDF(*[f"_{n}" for n in counted.columns])
    place = open_ranks["k"] - open_ranks["before"]
    fits = _same(open_ranks, counted, group) & (open_ranks["lo"] == counted["_lo"]) & (place >= counted["_before"]) & (place < counted["_before"] + counted["_c"])
    return settled.unionByName(open_ranks.join(counted, fits).select(*group, "n", "k", counted["_v"].alias("value")))


def grouped_quantiles(df: DataFrame, keys: Sequence[str], values: dict[str, Column], probs: Sequence[float], limit: int = LIMIT) -> DataFrame:
    """(keys, column, prob, value): linearly interpolated quantiles of each group and column that has values."""
    probs = [float(p) for p in probs]
    names = list(values)
    at = order_statistics(df, keys, [values[n] for n in names], probs, limit)
    # at most two ranks per quantile are gathered
    held = [f"g{j}" for j in range(len(keys))]
    per = at.groupBy(*held, "i", "n").agg(F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("at"))
    per = per.withColumn("prob", F.explode(F.array(*map(F.lit, probs))))
    low = F.floor(F.col("prob") * (F.col("n") - 1))
    a, b = F.element_at("at", low), F.element_at("at", F.least(low + 1, F.col("n") - 1))
    part = F.col("prob") * (F.col("n") - 1) - low
    value = F.when((a == b) | (part == 0), a).otherwise(a + (b - a) * part)
    name = F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1)
    return per.select(*(F.col(g).alias(k) for g, k in zip(held, keys)), name.alias("column"), "prob", value.alias("value"))


def _between(at: dict, i: int, n: int, p: float) -> float | None:
    """The interpolated value of column ``i``."""
    if not n:
        return None
    low = int(p * (n - 1))
    a, b, part = at[i, low], at[i, min(low + 1, n - 1)], p * (n - 1) - low
    return a if a == b or not part else a + (b - a) * part


def exact_quantiles(df: DataFrame, values: dict[str, Column], probs: Sequence[float], limit: int = LIMIT) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of many expressions: a number per column and probability, None without values."""
    probs = [float(p) for p in probs]
    if not values:
        return {}
    flat = _flat_statistics(_tall(df, [], list(values.values())), probs, limit)
    if flat is not None:
        at = {(i, k): v for i, _, k, v in flat}
        sizes = {i: n for i, n, _, _ in flat}
        return {name: [_between(at, i, sizes.get(i, 0), p) for p in probs] for i, name in enumerate(values)}
    got = {(r["column"], r["prob"]): r["value"] for r in grouped_quantiles(df, [], values, probs, limit).collect()}
    return {n: [got.get((n, p)) for p in probs] for n in values}
