"""Queries on validating and preparing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.functions.columns import as_number, is_finite, numeric_columns
from opspark.operators import prepare as pr, profile as pf
from opspark.plans.registry import query, table

Q = '"column"'  # a reserved word in SQL

# The given tables hold no nulls, so gaps are made by rule in both languages.
HOLED_SQL = """
  SELECT CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity,
         CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS price,
         l_discount AS discount, l_tax AS tax,
         CASE WHEN l_linenumber <= 2 THEN l_returnflag END AS flag, l_linestatus AS status
  FROM lineitem"""

ORDER_GAPS_SQL = """
  SELECT o_orderkey, o_orderstatus,
         CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_totalprice END AS price,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority
  FROM orders"""


def holed(spark, sf):
    n = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        F.when(n != 3, F.col("l_quantity")).alias("quantity"), F.when(n != 5, F.col("l_extendedprice")).alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        F.when(n <= 2, F.col("l_returnflag")).alias("flag"), F.col("l_linestatus").alias("status"))


def order_gaps(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"))


def tall(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


@query("table_shape", "A1 S4", "SELECT count(*)::BIGINT AS total_records, 6::BIGINT AS total_features FROM orders")
def _(spark, sf):
    return pf.shape(table(spark, sf, "orders"))


@query("missing_ratio", "A2", f"""
WITH t AS ({HOLED_SQL}), m AS (
{tall(*[f"SELECT '{c}' AS {Q}, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM t"
       for c in ("quantity", "price", "discount", "tax", "flag", "status")])})
SELECT "column", round(r, 6) AS missing_ratio, r > 0.5 AS over_threshold FROM m WHERE r > 0""")
def _(spark, sf):
    return pf.missing_ratio(holed(spark, sf)).withColumn("missing_ratio", F.round("missing_ratio", 6))


DUPLICATE_SQL = "SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem"


def repeated(spark, sf):
    return table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query("duplicate_count", "A3", f"""
SELECT ((SELECT count(*) FROM ({DUPLICATE_SQL})) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({DUPLICATE_SQL}))))::BIGINT
  AS duplicate_count""")
def _(spark, sf):
    return pf.duplicate_count(repeated(spark, sf))


@query("duplicate_rows", "A3", f"""
SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, count(*) - 1 AS extra_copies
FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    return pf.duplicate_rows(repeated(spark, sf))


@query("duplicate_copies", "A3", f"""
SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM (
  SELECT *, row_number() OVER (PARTITION BY l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS n
  FROM lineitem) WHERE n > 1""")
def _(spark, sf):
    return pf.explode_copies(pf.duplicate_rows(repeated(spark, sf)))


def fence_sql(c: str, t: str = "t") -> str:
    return (f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t})")


@query("outlier_counts_iqr", "A4 W8", f"""
WITH t AS (SELECT * FROM lineitem), o AS (
{tall(*[f'''SELECT '{c}' AS {Q}, count(*) AS outliers FROM t, {fence_sql(c)} f
  WHERE {c} < q1 - 0.3 * (q3 - q1) OR {c} > q3 + 0.3 * (q3 - q1)'''
       for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")])})
SELECT "column", outliers FROM o WHERE outliers > 0""")
def _(spark, sf):
    return pf.outlier_counts(table(spark, sf, "lineitem"), "iqr", 0.3)


@query("outlier_counts_zscore", "A4 X14", f"""
WITH o AS (
{tall(*[f'''SELECT '{c}' AS {Q}, count(*) AS outliers FROM events,
  (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM events) WHERE abs(({c} - m) / s) > 2'''
       for c in ("event_id", "user_id", "value")])})
SELECT "column", outliers FROM o WHERE outliers > 0""")
def _(spark, sf):
    return pf.outlier_counts(table(spark, sf, "events"), "zscore", 2.0)


@query("unique_counts", "A7", f"""
WITH t AS ({HOLED_SQL})
{tall(*[f"SELECT '{c}' AS {Q}, count(DISTINCT {c}) AS unique_count FROM t"
       for c in ("quantity", "price", "discount", "tax", "flag", "status")])}""")
def _(spark, sf):
    return pf.unique_counts(holed(spark, sf))


def _expect_sql():
    parts = []
    for c in ("l_orderkey", "l_quantity", "l_valid_id", "l_returnflag"):
        parts.append(f"SELECT '{c}' AS {Q}, 'not_null' AS expectation, count(*) FILTER ({c} IS NULL) AS unexpected FROM t")
    parts.append(f"""SELECT 'l_valid_id' AS {Q}, 'unique' AS expectation,
      coalesce(sum(CASE WHEN c > 1 THEN c END), 0)::BIGINT AS unexpected
      FROM (SELECT l_valid_id, count(*) AS c FROM t WHERE l_valid_id IS NOT NULL GROUP BY 1)""")
    return f"""WITH t AS (SELECT l_orderkey, l_quantity, CASE WHEN l_linenumber <> 4 THEN l_orderkey * 10 + l_linenumber END
      AS l_valid_id, l_returnflag FROM lineitem), e AS ({tall(*parts)})
    SELECT "column", expectation, unexpected, unexpected = 0 AS success FROM e"""


@query("expectations", "A9 X7", _expect_sql())
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    return pf.expectations(li.select(
        "l_orderkey", "l_quantity", F.when(F.col("l_linenumber") != 4, F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(
            "l_valid_id"), "l_returnflag"))


@query("validation_errors", "A10 A2 A3", f"""
WITH t AS ({HOLED_SQL})
SELECT 'flag' AS {Q}, 'missing_values' AS error, round(r, 6) AS amount
FROM (SELECT avg(CASE WHEN flag IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM t) WHERE r > 0.5
UNION ALL
SELECT NULL AS {Q}, 'duplicate_records' AS error, n::DOUBLE AS amount
FROM (SELECT (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS n) WHERE n > 0""")
def _(spark, sf):
    return pf.validation_errors(holed(spark, sf)).withColumn("amount", F.round("amount", 6))


@query("validation_verdict", "A10", """
SELECT 0::BIGINT + CASE WHEN n > 0 THEN 1 ELSE 0 END AS error_count, n = 0 AS validation_passed
FROM (SELECT (SELECT count(*) FROM orders) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS n)""")
def _(spark, sf):
    return pf.verdict(table(spark, sf, "orders"))


def _describe_sql(t, cols):
    return tall(*[f"""SELECT '{c}' AS {Q}, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
      min({c})::DOUBLE AS low, max({c})::DOUBLE AS high, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25,
      round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75 FROM {t}""" for c in cols])


@query("describe_lineitem", "A11 A12", f"WITH t AS ({HOLED_SQL}) " + _describe_sql("t", ("quantity", "price", "discount", "tax")))
def _(spark, sf):
    out = pf.describe(holed(spark, sf))
    return out.select("column", "n", "low", "high", *[F.round(c, 4).alias(c) for c in ("mean", "std", "q25", "q50", "q75")])


@query("pearson_matrix", "A11 A12", f"""
WITH t AS ({HOLED_SQL})
{tall(*[f"SELECT '{a}' AS left, '{b}' AS right, round(corr({a}, {b}), 6) AS pearson FROM t"
       for i, a in enumerate(("quantity", "price", "discount", "tax")) for b in ("quantity", "price", "discount", "tax")[i + 1:]])}
""".replace(" AS left", ' AS "left"').replace(" AS right", ' AS "right"'))
def _(spark, sf):
    return pf.pearson_matrix(holed(spark, sf), ["quantity", "price", "discount", "tax"]).withColumn("pearson", F.round("pearson", 6))


@query("spearman_matrix", "A11", """
WITH t AS (SELECT quantity, price, discount FROM (""" + HOLED_SQL + """)
           WHERE quantity IS NOT NULL AND price IS NOT NULL AND discount IS NOT NULL),
r AS (SELECT
  rank() OVER (ORDER BY quantity) + (count(*) OVER (PARTITION BY quantity) - 1) / 2.0 AS a,
  rank() OVER (ORDER BY price) + (count(*) OVER (PARTITION BY price) - 1) / 2.0 AS b,
  rank() OVER (ORDER BY discount) + (count(*) OVER (PARTITION BY discount) - 1) / 2.0 AS c FROM t)
SELECT 'quantity' AS "left", 'price' AS "right", round(corr(a, b), 6) AS spearman FROM r
UNION ALL SELECT 'quantity', 'discount', round(corr(a, c), 6) FROM r
UNION ALL SELECT 'price', 'discount', round(corr(b, c), 6) FROM r""")
def _(spark, sf):
    return pf.spearman_matrix(holed(spark, sf), ["quantity", "price", "discount"]).withColumn("spearman", F.round("spearman", 6))


@query("histogram_30_bins", "A12 X13", """
WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
c AS (SELECT least(floor((o_totalprice - lo) / ((hi - lo) / 30.0)), 29)::INT AS bin, count(*) AS rows FROM orders, e GROUP BY 1)
SELECT g.bin::INT AS bin, coalesce(c.rows, 0) AS rows FROM range(30) g(bin) LEFT JOIN c ON c.bin = g.bin""")
def _(spark, sf):
    return pf.histogram(table(spark, sf, "orders"), "o_totalprice", 30)


@query("label_counts", "A12", "SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY 1")
def _(spark, sf):
    return pf.value_counts(table(spark, sf, "orders"), "o_orderstatus")


@query("head_and_tail", "T3", """
SELECT * FROM (SELECT 'head' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20)
UNION ALL
SELECT * FROM (SELECT 'tail' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 20)""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    head = pf.head_rows(o, "o_orderkey").select(F.lit("head").alias("part"), "*")
    return head.unionByName(pf.head_rows(o, "o_orderkey", last=True).select(F.lit("tail").alias("part"), "*"))


def _quality_sql():
    t = """t AS (SELECT event_id, user_id, CASE WHEN event_type <> 'click' THEN value END AS value FROM events)"""
    parts = [f"""SELECT 'high_missing_values' AS type, '{c}' AS {Q}, r AS amount FROM
      (SELECT avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM t) WHERE r > 0.1""" for c in ("event_id", "user_id", "value")]
    parts += [f"""SELECT 'extreme_values' AS type, '{c}' AS {Q}, n::DOUBLE AS amount FROM (SELECT count(*) AS n FROM t,
      (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM t) WHERE s > 0 AND abs(({c} - m) / s) > 5) WHERE n > 0"""
              for c in ("event_id", "user_id", "value")]
    parts += [f"""SELECT 'duplicate_ids' AS type, '{c}' AS {Q}, n::DOUBLE AS amount FROM
      (SELECT count(*) - count(DISTINCT {c}) AS n FROM t) WHERE n > 0""" for c in ("event_id", "user_id")]
    return f"WITH {t}, i AS ({tall(*parts)})"


def quality_input(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") != "click", F.col("value")).alias("value"))


@query("quality_issues", "A13 X14", _quality_sql() + ' SELECT type, "column", round(amount, 6) AS amount FROM i')
def _(spark, sf):
    return pf.quality_issues(quality_input(spark, sf)).withColumn("amount", F.round("amount", 6))


@query("quality_score", "A13", _quality_sql() + """
SELECT count(*) AS issues, round(greatest(0.0, 1.0 - count(*) * 0.1), 4)::DOUBLE AS quality_score,
       round(greatest(0.0, 1.0 - count(*) * 0.1), 4) < 0.8 AS alert FROM i""")
def _(spark, sf):
    return pf.quality_score(quality_input(spark, sf)).withColumn("quality_score", F.round("quality_score", 4))


# -- preparation -------------------------------------------------------------

@query("drop_missing_rows", "P4", f"""
WITH t AS ({HOLED_SQL}) SELECT * FROM t
WHERE quantity IS NOT NULL AND price IS NOT NULL AND flag IS NOT NULL""")
def _(spark, sf):
    return pr.drop_missing(holed(spark, sf))


@query("drop_missing_report", "P4", f"""
WITH t AS ({HOLED_SQL}) SELECT
  count(*) FILTER (quantity IS NOT NULL AND price IS NOT NULL AND flag IS NOT NULL) AS rows_kept,
  count(*) FILTER (quantity IS NULL OR price IS NULL OR flag IS NULL) AS rows_dropped FROM t""")
def _(spark, sf):
    return pr.drop_report(holed(spark, sf))


def _impute_sql(agg):
    return f"""
WITH t AS ({ORDER_GAPS_SQL}), f AS (SELECT {agg} AS p FROM t),
m AS (SELECT priority AS v FROM t WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, o_orderstatus, round(coalesce(price, f.p), 4) AS price, coalesce(priority, m.v) AS priority FROM t, f, m"""


def _imputed(spark, sf, method):
    df = order_gaps(spark, sf)
    fill = pr.fit_imputer(df, method)
    out = pr.apply_imputer(df, fill)
    return out.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus",
                      F.round("price", 4).alias("price"), "priority")


@query("impute_mean", "A5", _impute_sql("avg(price)"))
def _(spark, sf):
    return _imputed(spark, sf, "mean")


@query("impute_median", "A5", _impute_sql("quantile_cont(price, 0.5)"))
def _(spark, sf):
    return _imputed(spark, sf, "median")


@query("impute_numeric_mode_as_median", "A5", _impute_sql("quantile_cont(price, 0.5)"))
def _(spark, sf):
    return _imputed(spark, sf, "mode")


@query("impute_nearest_rows", "A6 J7", """
WITH t AS (SELECT p_partkey, p_size::DOUBLE AS size, CASE WHEN p_brand <> 'Brand#2' THEN p_retailprice END AS price,
             CASE WHEN p_type <> 'ECONOMY' THEN length(p_name)::DOUBLE END AS letters FROM part),
d AS (SELECT g.p_partkey AS k, d.price AS v, d.p_partkey AS dk,
        3.0 * ((g.size - d.size) * (g.size - d.size) +
               coalesce((g.letters - d.letters) * (g.letters - d.letters), 0.0)) /
        (1 + CASE WHEN g.letters IS NULL OR d.letters IS NULL THEN 0 ELSE 1 END) AS dist
      FROM t g JOIN t d ON g.price IS NULL AND d.price IS NOT NULL),
n AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY dist, dk) AS r FROM d),
f AS (SELECT k, avg(v) AS fill FROM n WHERE r <= 5 GROUP BY 1)
SELECT p_partkey, round(coalesce(price, fill), 4) AS price FROM t LEFT JOIN f ON p_partkey = k""")
def _(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"),
        F.when(F.col("p_brand") != "Brand#2", F.col("p_retailprice")).alias("price"),
        F.when(F.col("p_type") != "ECONOMY", F.length("p_name")).cast("double").alias("letters"))
    out = pr.knn_impute(p, "p_partkey", ["price", "size", "letters"])
    return out.select("p_partkey", F.round("price", 4).alias("price"))


PRICE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("remove_outliers_iqr", "P8", f"""
WITH t AS ({HOLED_SQL}), a AS {fence_sql('quantity')}, b AS {fence_sql('price')},
c AS {fence_sql('discount')}, d AS {fence_sql('tax')}
SELECT t.* FROM t, a, b, c, d WHERE
  NOT coalesce(quantity < a.q1 - 0.3 * (a.q3 - a.q1) OR quantity > a.q3 + 0.3 * (a.q3 - a.q1), false)
  AND NOT coalesce(price < b.q1 - 0.3 * (b.q3 - b.q1) OR price > b.q3 + 0.3 * (b.q3 - b.q1), false)
  AND NOT coalesce(discount < c.q1 - 0.3 * (c.q3 - c.q1) OR discount > c.q3 + 0.3 * (c.q3 - c.q1), false)
  AND NOT coalesce(tax < d.q1 - 0.3 * (d.q3 - d.q1) OR tax > d.q3 + 0.3 * (d.q3 - d.q1), false)""")
def _(spark, sf):
    df = holed(spark, sf)
    return pr.apply_outliers(df, pr.fit_outliers(df, "iqr", 0.3))


@query("remove_outliers_zscore", "P9 X14", f"""
WITH t AS ({HOLED_SQL}), s AS (SELECT avg(quantity) AS am, stddev_samp(quantity) AS a, avg(price) AS bm, stddev_samp(price) AS b,
  avg(discount) AS cm, stddev_samp(discount) AS c, avg(tax) AS dm, stddev_samp(tax) AS d FROM t)
SELECT t.* FROM t, s WHERE abs((quantity - am) / a) <= 1.5 AND abs((price - bm) / b) <= 1.5
  AND abs((discount - cm) / c) <= 1.5 AND abs((tax - dm) / d) <= 1.5""")
def _(spark, sf):
    df = holed(spark, sf)
    return pr.apply_outliers(df, pr.fit_outliers(df, "zscore", 1.5))


@query("scale_standard", "A16 M1", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS o_totalprice FROM orders, s""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return pr.apply_scaler(o, pr.fit_scaler(o, cols=["o_totalprice"])).withColumn("o_totalprice", F.round("o_totalprice", 6))


@query("scale_robust", "A16 M1", """
WITH s AS (SELECT quantile_cont(o_totalprice, 0.5) AS m, quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) AS d FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS o_totalprice FROM orders, s""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return pr.apply_scaler(o, pr.fit_scaler(o, True, cols=["o_totalprice"])).withColumn("o_totalprice", F.round("o_totalprice", 6))


SPLIT_SQL = """
SELECT o_orderkey, CASE WHEN r <= floor(n * 0.2 + 0.5) THEN 'test'
  WHEN r <= floor(n * 0.2 + 0.5) + floor(n * 0.1 + 0.5) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT o_orderkey, row_number() OVER ({part} ORDER BY md5(o_orderkey::VARCHAR || '-42'), o_orderkey) AS r,
             count(*) OVER ({part}) AS n FROM orders)"""


@query("split_stratified", "M2", SPLIT_SQL.format(part="PARTITION BY o_orderstatus"))
def _(spark, sf):
    return pr.split(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus").select(
        "o_orderkey", "split")


@query("split_plain", "M2", SPLIT_SQL.format(part=""))
def _(spark, sf):
    return pr.split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("split_many_labels", "M2", SPLIT_SQL.format(part="PARTITION BY user_id").replace("o_orderkey", "event_id").replace(
    "orders", "events"))
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id")
    return pr.split(e, "event_id", "user_id", max_strata=100).select("event_id", "split")


@query("split_is_disjoint", "U4", "SELECT 0::BIGINT AS shared_keys FROM (SELECT count(*) FROM orders)")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return pr.split_overlap(pr.split(o, "o_orderkey", "o_orderstatus"), "o_orderkey")


@query("folds_stratified", "M22", """
SELECT o_orderkey, ((row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || '-42'), o_orderkey) - 1) % 5)::INT
  AS fold FROM orders""")
def _(spark, sf):
    return pr.folds(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus").select("o_orderkey", "fold")


@query("finite_guard", "P7", """
SELECT event_id, value / nullif((user_id % 4)::DOUBLE, 0) AS ratio FROM events
WHERE user_id % 4 <> 0 AND isfinite(value / (user_id % 4)::DOUBLE)""")
def _(spark, sf):
    e = table(spark, sf, "events")
    part = F.col("user_id") % 4
    ratio = F.when(part != 0, F.col("value") / part).otherwise(F.lit(float("inf")))
    return e.select("event_id", ratio.alias("ratio")).where(is_finite(F.col("ratio")))


@query("score_with_noise", "P12", """
SELECT event_id, round(value * 0.5 + ('0x' || substr(md5(event_id::VARCHAR || '-7'), 1, 7))::BIGINT / 268435456.0, 6) AS score FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.round(pr.noisy_score(F.col("value"), F.col("event_id")), 6).alias("score"))


@query("score_shifted", "P12", "SELECT event_id, round((value + 1) * 0.42, 6) AS prediction FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(pr.shifted_score(F.col("value")), 6).alias("prediction"))


@query("feature_target_columns", "P1 P2 P3 P13", """
SELECT l_extendedprice, l_quantity, l_tax, (l_returnflag = 'R')::INT AS target FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("is_returned", (F.col("l_returnflag") == "R").cast("int"))
    li = li.withColumnRenamed("is_returned", "target").drop("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount")
    from opspark.operators.features import project

    return project(li, sorted(numeric_columns(li, ["target"])))


@query("prepared_orders", "A5 P8 A16 M2", f"""
WITH t AS ({ORDER_GAPS_SQL}),
m AS (SELECT priority AS v FROM t WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
i AS (SELECT o_orderkey, o_orderstatus, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM t)) AS price,
        coalesce(priority, m.v) AS priority FROM t, m),
k AS (SELECT i.* FROM i, {fence_sql('price', 'i')} f WHERE price BETWEEN q1 - 0.8 * (q3 - q1) AND q3 + 0.8 * (q3 - q1)),
r AS (SELECT k.*, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || '-42'), o_orderkey) AS r,
        count(*) OVER (PARTITION BY o_orderstatus) AS n,
        avg(price) OVER () AS m, stddev_pop(price) OVER () AS d FROM k)
SELECT o_orderkey, o_orderstatus, round((price - m) / d, 4) AS price, priority,
  CASE WHEN r <= floor(n * 0.2 + 0.5) THEN 'test'
  WHEN r <= floor(n * 0.2 + 0.5) + floor(n * 0.1 + 0.5) THEN 'validation' ELSE 'train' END AS split FROM r""")
def _(spark, sf):
    from opspark.plans.workflows import prepare_table

    done = prepare_table(order_gaps(spark, sf), "o_orderkey", "o_orderstatus", {"outlier_threshold": 0.8})
    return done.table.withColumn("price", F.round("price", 4))
