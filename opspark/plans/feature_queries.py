"""Queries on feature engineering, selection and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.operators import features as fe, models as mo
from opspark.plans.registry import query, table
from opspark.plans.table_queries import tall

NUMS = ["quantity", "price", "discount", "tax"]

LABELLED_SQL = """
  SELECT l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
         (l_returnflag = 'R')::INT AS target FROM lineitem"""


def labelled(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        (F.col("l_returnflag") == "R").cast("int").alias("target"))


def rounded(df, *cols, places=4):
    cols = cols or [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.select(*[F.round(F.col(f"`{c}`"), places).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


@query("polynomial_degree_2", "M3 J5", """
SELECT round(l_quantity, 4) AS l_quantity, round(l_discount, 4) AS l_discount, round(l_tax, 4) AS l_tax,
  round(l_quantity * l_quantity, 4) AS "l_quantity^2", round(l_quantity * l_discount, 4) AS "l_quantity l_discount",
  round(l_quantity * l_tax, 4) AS "l_quantity l_tax", round(l_discount * l_discount, 4) AS "l_discount^2",
  round(l_discount * l_tax, 4) AS "l_discount l_tax", round(l_tax * l_tax, 4) AS "l_tax^2",
  l_returnflag, (l_returnflag = 'R')::INT AS target FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag",
                                             (F.col("l_returnflag") == "R").cast("int").alias("target"))
    return rounded(fe.polynomial_features(li, 2))


@query("polynomial_interactions_3", "M3", """
SELECT event_id::DOUBLE AS event_id, user_id::DOUBLE AS user_id, value, round(event_id * user_id::DOUBLE, 2) AS "event_id user_id",
  round(event_id * value, 2) AS "event_id value", round(user_id * value, 2) AS "user_id value",
  round(event_id::DOUBLE * user_id * value, 2) AS "event_id user_id value" FROM events""")
def _(spark, sf):
    return rounded(fe.polynomial_features(table(spark, sf, "events").select("event_id", "user_id", "value"), 3, True), places=2)


CENTRES = [[10.0, 20000.0, 0.02, 0.01], [25.0, 60000.0, 0.05, 0.04], [45.0, 90000.0, 0.08, 0.07]]


def _cluster_sql():
    dist = [" + ".join(f"({c} - {v}) * ({c} - {v})" for c, v in zip(NUMS, centre)) for centre in CENTRES]
    cols = ", ".join(f"sqrt({d}) AS d{i}" for i, d in enumerate(dist))
    return f"""WITH t AS ({LABELLED_SQL}), d AS (SELECT t.*, {cols} FROM t)
    SELECT quantity, price, round(d0, 4) AS distance_to_cluster_0, round(d1, 4) AS distance_to_cluster_1,
      round(d2, 4) AS distance_to_cluster_2,
      CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM d"""


@query("cluster_distances", "M5 J8", _cluster_sql())
def _(spark, sf):
    out = fe.cluster_features(labelled(spark, sf), NUMS, CENTRES)
    return rounded(out.drop("discount", "tax", "target"), *[f"distance_to_cluster_{i}" for i in range(3)])


@query("centroid_distance_vectors", "M5 J8 X6", """
WITH u AS (SELECT label, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(x::DOUBLE) AS m FROM u GROUP BY 1, 2)
SELECT u.vec_id, round(sqrt(sum((u.x::DOUBLE - c.m) * (u.x::DOUBLE - c.m))), 4) AS distance
FROM u JOIN c ON u.label = c.label AND u.i = c.i GROUP BY 1""")
def _(spark, sf):
    from opspark.session import bounded_broadcast

    e = table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    parts = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    centre = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    both = e.join(bounded_broadcast(centre, 10_000), "label")
    return both.select("vec_id", F.round(fe.array_distance(F.col("embedding"), F.col("c")), 4).alias("distance"))


@query("one_hot_priority", "M6", f"""
SELECT o_orderkey, {", ".join(f"(o_orderpriority = '{p}')::INT::DOUBLE AS " + '"' + f"o_orderpriority_{p}" + '"'
                              for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))} FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return fe.apply_encoders(o, fe.fit_encoders(o, "onehot"))


@query("one_hot_unknown_category", "M6", """
SELECT o_orderkey, (o_orderstatus = 'F')::INT::DOUBLE AS "o_orderstatus_F", (o_orderstatus = 'O')::INT::DOUBLE AS "o_orderstatus_O"
FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return fe.apply_encoders(o, fe.fit_encoders(o.where("o_orderstatus <> 'P'"), "onehot"))


@query("label_encode_names", "M7 J3", """
SELECT p_partkey, (dense_rank() OVER (ORDER BY p_name) - 1)::INT AS p_name FROM part""")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return fe.label_encode(p, "p_name", fe.categories(p, "p_name"))


@query("label_encode_unknown", "M7 J3", """
WITH c AS (SELECT c_mktsegment AS v, row_number() OVER (ORDER BY c_mktsegment) - 1 AS code
           FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_nationkey = 0 OR c_mktsegment < 'C'))
SELECT c_custkey, coalesce(code, -1)::INT AS c_mktsegment FROM customer
LEFT JOIN (SELECT v, code FROM c WHERE v < 'M') ON v = customer.c_mktsegment""")
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    known = fe.categories(c.where("c_nationkey = 0 OR c_mktsegment < 'C'"), "c_mktsegment").where("category < 'M'")
    return fe.label_encode(c.drop("c_nationkey"), "c_mktsegment", known)


@query("target_encode_means", "M8 A14", """
SELECT l_linestatus AS category, round(avg((l_returnflag = 'R')::INT), 6) AS mean FROM lineitem GROUP BY 1""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("target", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(fe.fit_target_means(li, "l_linestatus"), places=6)


@query("target_encode_unknown", "M8 A14 A15 J3 Y3", """
WITH m AS (SELECT o_orderpriority AS v, avg(o_totalprice) AS m FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)
SELECT o_orderkey, round(coalesce(m.m, (SELECT avg(m) FROM m)), 4) AS o_orderpriority FROM orders LEFT JOIN m ON v = o_orderpriority""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("target"))
    means = fe.fit_target_means(o.where("o_orderpriority <> '5-LOW'"), "o_orderpriority")
    return rounded(fe.target_encode(o, "o_orderpriority", means).drop("target"))


@query("feature_variances", "M9", f"""
WITH t AS ({LABELLED_SQL})
SELECT feature, round(v, 4) AS variance, v > 0.01 AS kept FROM (
{tall(*[f"SELECT '{c}' AS feature, var_pop({c}) AS v FROM t" for c in NUMS])})""")
def _(spark, sf):
    out = fe.variances(labelled(spark, sf), NUMS)
    return out.select("feature", F.round("variance", 4).alias("variance"), (F.col("variance") > 0.01).alias("kept"))


@query("chi_square_scores", "M11", f"""
WITH t AS ({LABELLED_SQL}), s AS ({tall(*[
    f"SELECT '{c}' AS feature, target, sum({c}) AS o, count(*) AS n FROM t GROUP BY 2" for c in NUMS])}),
e AS (SELECT feature, o, sum(o) OVER (PARTITION BY feature) * n / sum(n) OVER (PARTITION BY feature) AS e FROM s)
SELECT feature, round(sum((o - e) * (o - e) / e), 4) AS score FROM e GROUP BY 1""")
def _(spark, sf):
    return rounded(fe.score_features(labelled(spark, sf), NUMS, "chi2"))


@query("anova_scores", "M12 M10", f"""
WITH t AS ({LABELLED_SQL}), s AS ({tall(*[
    f"SELECT '{c}' AS feature, target, avg({c}) AS m, count(*) AS n, var_pop({c}) * count(*) AS w, (SELECT avg({c}) FROM t) AS g FROM t GROUP BY 2"
    for c in NUMS])})
SELECT feature, round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))), 4) AS score FROM s GROUP BY 1""")
def _(spark, sf):
    return rounded(fe.score_features(labelled(spark, sf), NUMS, "anova"))


@query("regression_scores", "M13 M10", """
WITH r AS (SELECT 'l_quantity' AS feature, corr(l_quantity, l_extendedprice) AS r, count(*) AS n FROM lineitem
  UNION ALL SELECT 'l_discount', corr(l_discount, l_extendedprice), count(*) FROM lineitem
  UNION ALL SELECT 'l_tax', corr(l_tax, l_extendedprice), count(*) FROM lineitem)
SELECT feature, round(r * r / (1 - r * r) * (n - 2), 4) AS score FROM r""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("target"))
    return rounded(fe.score_features(li, ["l_quantity", "l_discount", "l_tax"], "anova"))


def _mutual_sql():
    cut = " + ".join("(v > q{0})::INT".format(i) for i in range(1, 10))
    probs = ", ".join(f"quantile_cont(v, 0.{i}) AS q{i}" for i in range(1, 10))
    parts = tall(*[f"SELECT '{c}' AS feature, {c} AS v, target AS y FROM t" for c in NUMS])
    return f"""WITH t AS ({LABELLED_SQL}), a AS ({parts}), q AS (SELECT feature, {probs} FROM a GROUP BY 1),
    b AS (SELECT feature, {cut} AS x, y FROM a JOIN q USING (feature)),
    c AS (SELECT feature, x, y, count(*)::DOUBLE AS c FROM b GROUP BY ALL),
    d AS (SELECT *, sum(c) OVER (PARTITION BY feature, x) AS cx, sum(c) OVER (PARTITION BY feature, y) AS cy,
      sum(c) OVER (PARTITION BY feature) AS n FROM c)
    SELECT feature, round(sum(c / n * ln(c * n / (cx * cy))), 6) AS score FROM d GROUP BY 1"""


@query("mutual_information", "M14", _mutual_sql())
def _(spark, sf):
    return rounded(fe.mutual_information(labelled(spark, sf), NUMS), places=6)


@query("top_features", "T1 M12", f"""
WITH t AS ({LABELLED_SQL}), s AS ({tall(*[
    f"SELECT '{c}' AS feature, target, avg({c}) AS m, count(*) AS n, var_pop({c}) * count(*) AS w, (SELECT avg({c}) FROM t) AS g FROM t GROUP BY 2"
    for c in NUMS])}), f AS (
SELECT feature, (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))) AS score FROM s GROUP BY 1)
SELECT feature, round(score, 4) AS score FROM f ORDER BY f.score DESC, feature LIMIT 2""")
def _(spark, sf):
    return rounded(fe.top_features(fe.anova_scores(labelled(spark, sf), NUMS), 2))


@query("selected_columns", "M16 P13 M9", f"WITH t AS ({LABELLED_SQL}) SELECT quantity, price, target FROM t")
def _(spark, sf):
    df = labelled(spark, sf)
    return fe.project(df, fe.keep_varying(df, NUMS))


@query("fitted_flow_on_test_part", "M17 M3 M8 M11", """
WITH p AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || '-42'), o_orderkey) AS r,
             count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders),
s AS (SELECT o_orderkey, o_totalprice AS a, (o_custkey % 100)::DOUBLE AS b, o_orderpriority AS p, (o_orderstatus = 'F')::INT AS target,
   CASE WHEN r <= floor(n * 0.2 + 0.5) THEN 'test' WHEN r <= floor(n * 0.2 + 0.5) + floor(n * 0.1 + 0.5) THEN 'validation' ELSE 'train' END AS split FROM p),
m AS (SELECT p AS v, avg(target) AS m FROM s WHERE split = 'train' GROUP BY 1)
SELECT round(a, 2) AS a, round(b, 2) AS b, round(a * a, 2) AS "a^2", round(a * b, 2) AS "a b", round(b * b, 2) AS "b^2", target
FROM s JOIN m ON v = p WHERE split = 'test'""")
def _(spark, sf):
    from opspark.operators.prepare import split
    from opspark.plans.workflows import fit_features

    parts = split(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus").select(
        "split", F.col("o_totalprice").alias("a"), (F.col("o_custkey") % 100).cast("double").alias("b"),
        F.col("o_orderpriority").alias("p"), (F.col("o_orderstatus") == "F").cast("int").alias("target"))
    train = parts.where("split = 'train'").drop("split")
    flow = fit_features(train, engineering={"create_clusters": False}, selection={"method": "chi2", "variance_threshold": 0.01})
    out = flow.apply(parts.where("split = 'test'").drop("split"))
    return rounded(out.select("a", "b", "`a^2`", "`a b`", "`b^2`", "target"), places=2)


# -- fits: the draws of the learners have no SQL counterpart ------------------

@query("kmeans_labels", "M4 M5")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    out = fe.cluster_features(df, cols, fe.fit_clusters(df, cols, 5))
    return out.groupBy("cluster").agg(F.count("*").alias("rows"))


@query("recursive_elimination", "M15")
def _(spark, sf):
    kept = fe.recursive_elimination(labelled(spark, sf), NUMS, keep=2, trees=10)
    return spark.createDataFrame(kept, "feature string, importance double")


def _forest_data(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_custkey") % 100).alias("group"), F.month("o_orderdate").alias("month"),
        (F.col("o_orderstatus") == "F").cast("int").alias("target"))


@query("random_forest_scores", "M18 M23")
def _(spark, sf):
    cols = ["o_totalprice", "group", "month"]
    df = _forest_data(spark, sf)
    return mo.score_table(mo.fit_forest(df, cols, trees=10, max_depth=5), df, cols, ["o_orderkey"])


@query("boosted_regression_scores", "M19 M23")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", F.col("l_extendedprice").alias("target"))
    model = mo.fit_boosted(df, ["l_quantity", "l_discount"], regression=True, rounds=5, max_depth=3)
    return mo.score_table(model, df, ["l_quantity", "l_discount"], ["l_orderkey"])


@query("logistic_accuracy", "M20 A17")
def _(spark, sf):
    df = _forest_data(spark, sf)
    cols = ["o_totalprice", "group", "month"]
    scored = mo.score_table(mo.fit_logistic(df, cols, max_iter=20), df, cols, ["target"])
    return scored.agg(F.avg((F.col("prediction") == F.col("target")).cast("double")).alias("accuracy"))


@query("grid_search_folds", "M21 M22 A39")
def _(spark, sf):
    from opspark.operators.prepare import folds

    df = folds(_forest_data(spark, sf), "o_orderkey", "target", k=3)
    model = mo.fit_grid(df, ["o_totalprice", "group"], depths=(2, 3), trees=(5,), folds=3, fold_col="fold")
    return spark.createDataFrame(mo.grid_scores(model), "settings string, accuracy double, std double")
