"""Learners on rules of the given tables with known answers, and checks on values far from zero, nulls and schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.operators import evaluate as ev, features as fe, models as mo, profile as pf
from opspark.plans.feature_queries import NUMS, labelled, rounded
from opspark.plans.registry import query, table
from opspark.streaming import sensor as se

#: A label that a rule on two columns makes, and a column that says nothing about it.
RULE_SQL = "SELECT l_quantity AS quantity, l_discount AS discount, l_linenumber AS line, (l_quantity > 25)::INT AS target FROM lineitem"
FACT_SQL = f"WITH t AS ({RULE_SQL}) SELECT target, count(*) AS rows, count(*) AS right_rows FROM t GROUP BY target"


def _rule(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_linenumber").alias("line"),
        (F.col("l_quantity") > 25).cast("int").alias("target"))


def _right(model, df):
    scored = mo.score_table(model, df, ["quantity", "discount"], ["target"])
    return scored.groupBy("target").agg(F.count("*").alias("rows"), F.count_if(F.abs(F.col("prediction") - F.col("target")) < 0.01).alias("right_rows"))


@query("forest_on_a_rule", "M18 M23", FACT_SQL)
def _(spark, sf):
    df = _rule(spark, sf)
    return _right(mo.fit_forest(df, ["quantity", "discount"], trees=5, max_depth=4, subset="all"), df)


@query("forest_regression_on_a_rule", "M18 M23", FACT_SQL)
def _(spark, sf):
    df = _rule(spark, sf)
    return _right(mo.fit_forest(df, ["quantity", "discount"], regression=True, trees=5, max_depth=4, subset="all"), df)


@query("boosting_on_a_rule", "M19 M23", FACT_SQL)
def _(spark, sf):
    df = _rule(spark, sf)
    return _right(mo.fit_boosted(df, ["quantity", "discount"], rounds=5, max_depth=3, subsample=1.0), df)


@query("boosted_regression_on_a_rule", "M19 M23", FACT_SQL)
def _(spark, sf):
    df = _rule(spark, sf)
    return _right(mo.fit_boosted(df, ["quantity", "discount"], regression=True, rounds=5, max_depth=3, subsample=1.0), df)


@query("logistic_on_a_rule", "M20 A17", f"WITH t AS ({RULE_SQL}) SELECT count(*) AS rows, true AS beats_majority FROM t")
def _(spark, sf):
    df = _rule(spark, sf)
    scored = mo.score_table(mo.fit_logistic(df, ["quantity", "discount"], max_iter=50), df, ["quantity", "discount"], ["target"])
    right, share = F.avg((F.col("prediction") == F.col("target")).cast("double")), F.avg("target")
    return scored.agg(F.count("*").alias("rows"), (right > F.greatest(share, 1 - share) + 0.2).alias("beats_majority"))


@query("grid_finds_the_depth", "M21 M22", "SELECT 'maxDepth=4,numTrees=3' AS best")
def _(spark, sf):
    # a band needs two cuts, which one level can't make; the tables only give the rows
    df = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"),
        F.col("l_quantity").between(15, 35).cast("int").alias("target"), F.pmod("l_orderkey", F.lit(3)).cast("int").alias("fold"))
    scores = mo.grid_scores(mo.fit_grid(df, ["q", "d"], depths=(1, 4), trees=(3,), folds=3, fold_col="fold"))
    return spark.createDataFrame([(max(scores, key=lambda s: s[1])[0],)], "best string")


@query("elimination_keeps_the_rule", "M15", "SELECT 'quantity' AS feature")
def _(spark, sf):
    kept = fe.recursive_elimination(_rule(spark, sf), ["quantity", "discount", "line"], keep=1, trees=5)
    return spark.createDataFrame(kept, "feature string, importance double").select("feature")


@query("kmeans_on_separate_groups", "M4 M5", """
SELECT l_returnflag AS flag, count(*) AS rows, 1 AS clusters FROM lineitem GROUP BY 1""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    place = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1000).otherwise(2000)
    df = li.select("l_returnflag", (place + F.col("l_discount")).alias("x"), (place + F.col("l_tax")).alias("y"))
    out = fe.cluster_features(df, ["x", "y"], fe.fit_clusters(df, ["x", "y"], 3))
    return out.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("rows"), F.countDistinct("cluster").cast("int").alias("clusters"))


@query("anova_scores_far_from_zero", "M12", """
WITH t AS (SELECT l_quantity AS v, (l_returnflag = 'R')::INT AS y FROM lineitem),
s AS (SELECT avg(v) AS m, count(*) AS n, var_pop(v) * count(*) AS w, (SELECT avg(v) FROM t) AS g FROM t GROUP BY y)
SELECT 'quantity' AS feature, round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))), 2) AS score FROM s""")
def _(spark, sf):
    # the same spread at 10^9, like times in seconds: the score does not change
    df = labelled(spark, sf).withColumn("quantity", F.col("quantity") + 1e9)
    return rounded(fe.anova_scores(df, ["quantity"]), places=2)


@query("confusion_with_null_labels", "A19", """
WITH t AS (SELECT nullif(event_type, 'view') AS y, CASE WHEN value > 50 THEN event_type END AS p FROM events),
l AS (SELECT y AS v FROM t UNION SELECT p FROM t), c AS (SELECT y, p, count(*) AS rows FROM t GROUP BY ALL)
SELECT a.v AS y, b.v AS p, coalesce(c.rows, 0) AS rows FROM l a CROSS JOIN l b
LEFT JOIN c ON c.y IS NOT DISTINCT FROM a.v AND c.p IS NOT DISTINCT FROM b.v""")
def _(spark, sf):
    e = table(spark, sf, "events")
    df = e.select(F.nullif("event_type", F.lit("view")).alias("y"), F.when(F.col("value") > 50, F.col("event_type")).alias("p"))
    return ev.confusion_matrix(df, "y", "p")


@query("window_features_null_key", "A41 R7", """
WITH w AS (SELECT nullif(event_type, 'view') AS sensor_id, time_bucket(INTERVAL 1 DAY, ts) AS w, value FROM events),
s AS (SELECT sensor_id, w, avg(value) AS a, stddev_pop(value) AS s FROM w GROUP BY 1, 2)
SELECT w.sensor_id, epoch_ms(w.w)::BIGINT AS window_start, count(*) AS count, count(*) FILTER (abs(value - a) > 2.5 * s) AS anomaly_count
FROM w JOIN s ON w.sensor_id IS NOT DISTINCT FROM s.sensor_id AND w.w = s.w GROUP BY 1, 2""")
def _(spark, sf):
    e = table(spark, sf, "events")
    df = e.select(F.nullif("event_type", F.lit("view")).alias("sensor_id"), F.col("ts").cast("timestamp").alias("event_time"), "value")
    return se.window_features(df, width="1 day").select("sensor_id", "window_start", "count", "anomaly_count")


@query("schema_check", "A8 U3", """
WITH have AS (SELECT column_name, column_type FROM (DESCRIBE SELECT * FROM orders)),
wanted(column_name, family, types) AS (VALUES ('o_orderkey', 'int', ['TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT']),
  ('o_totalprice', 'string', ['VARCHAR']), ('o_comment_count', 'int', ['BIGINT']), ('o_orderstatus', 'string', ['VARCHAR']), ('o_orderpriority', 'int', ['BIGINT'])),
o AS (SELECT *, o_orderpriority[1:1] || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'x' END AS p FROM orders),
c(column_name, nulls, rejected) AS (SELECT 'o_orderkey', count(*) FILTER (o_orderkey IS NULL), count(*) FILTER (o_orderkey IS NOT NULL AND TRY_CAST(o_orderkey AS BIGINT) IS NULL) FROM o
  UNION ALL SELECT 'o_totalprice', count(*) FILTER (o_orderkey % 7 = 0), 0 FROM o UNION ALL SELECT 'o_orderstatus', count(*) FILTER (o_orderstatus IS NULL), 0 FROM o
  UNION ALL SELECT 'o_orderpriority', count(*) FILTER (p IS NULL), count(*) FILTER (p IS NOT NULL AND TRY_CAST(p AS BIGINT) IS NULL) FROM o)
SELECT column_name AS "column", family AS expected, CASE WHEN column_type IS NULL THEN 'missing' WHEN NOT list_contains(types, column_type) THEN 'type' END AS error,
  (SELECT count(*) FROM orders) AS rows, nulls, rejected
FROM wanted LEFT JOIN have USING (column_name) LEFT JOIN c USING (column_name)""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    o = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))).withColumn(
        "o_orderpriority", F.concat(F.substring("o_orderpriority", 1, 1), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise("x")))
    return pf.schema_check(o, {
        "o_orderkey": "int", "o_totalprice": "string", "o_comment_count": "int", "o_orderstatus": "string", "o_orderpriority": "int"})
