"""Queries on evaluating predictions and measuring drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.operators import drift as dr, evaluate as ev
from opspark.plans.feature_queries import rounded
from opspark.plans.registry import query, table
from opspark.plans.table_queries import tall

# truth = return flag, prediction = a rule on quantity and status
CLASS_SQL = """
  SELECT l_returnflag AS y, CASE WHEN l_quantity > 35 THEN 'R' WHEN l_linestatus = 'O' THEN 'N' ELSE 'A' END AS p,
         CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 'reference' ELSE 'current' END AS side FROM lineitem"""


def classes(spark, sf):
    rule = F.when(F.col("l_quantity") > 35, "R").when(F.col("l_linestatus") == "O", "N").otherwise("A")
    side = F.when(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"), "reference").otherwise("current")
    return table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("y"), rule.alias("p"), side.alias("side"))


REPORT_SQL = """
  l AS (SELECT y AS v FROM t UNION SELECT p FROM t),
  r AS (SELECT v AS label, (SELECT count(*) FROM t WHERE y = v AND p = v) AS hits, (SELECT count(*) FROM t WHERE p = v) AS f,
          (SELECT count(*) FROM t WHERE y = v) AS support FROM l),
  m AS (SELECT label, coalesce(hits / nullif(f, 0)::DOUBLE, 0) AS precision, coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall,
          coalesce(2.0 * hits / nullif(f + support, 0), 0) AS f1, support, hits FROM r)"""


@query("classification_metrics", "A17", f"""
WITH t AS ({CLASS_SQL}), {REPORT_SQL}
SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(sum(precision * support) / sum(support), 6) AS precision,
  round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1 FROM m""")
def _(spark, sf):
    return rounded(ev.classification_metrics(classes(spark, sf), "y", "p"), places=6)


@query("class_report", "A18", f"""
WITH t AS ({CLASS_SQL}), {REPORT_SQL}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM m
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM m
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM m""")
def _(spark, sf):
    report = ev.class_report(classes(spark, sf), "y", "p")
    both = report.drop("hits").unionByName(ev.report_averages(report))
    return rounded(both, places=6)


@query("confusion_matrix", "A19", f"""
WITH t AS ({CLASS_SQL}), l AS (SELECT y AS v FROM t UNION SELECT p FROM t),
c AS (SELECT y, p, count(*) AS rows FROM t GROUP BY ALL)
SELECT a.v AS y, b.v AS p, coalesce(c.rows, 0) AS rows FROM l a CROSS JOIN l b LEFT JOIN c ON c.y = a.v AND c.p = b.v""")
def _(spark, sf):
    return ev.confusion_matrix(classes(spark, sf), "y", "p")


SCORE_SQL = """
  SELECT l.doc_id, l.quality AS y, ln(1 + d.n_chars) AS s FROM labels l JOIN documents d USING (doc_id)"""


def scored(spark, sf):
    # labels and documents are both keyed by document, so this is a plain equi-join
    both = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return both.select("doc_id", F.col("quality").alias("y"), F.ln(1 + F.col("n_chars")).alias("s"))


CURVE_SQL = f"""
WITH t AS ({SCORE_SQL}), g AS (SELECT round(s, 6) AS s, sum((y = 1)::INT) AS pos, sum((y <> 1)::INT) AS neg FROM t GROUP BY 1),
c AS (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
        sum(pos) OVER () AS ap, sum(neg) OVER () AS an FROM g)"""


def scored6(spark, sf):
    return scored(spark, sf).withColumn("s", F.round("s", 6))


@query("roc_curve", "A20 W8", CURVE_SQL + """
SELECT s AS threshold, round(fp / an, 6) AS fpr, round(tp / ap, 6) AS tpr FROM c""")
def _(spark, sf):
    return rounded(ev.roc_curve(scored6(spark, sf), "y", "s"), places=6)


@query("roc_auc", "A20", CURVE_SQL + """,
d AS (SELECT fp / an AS x, tp / ap AS y, lag(fp / an, 1, 0) OVER (ORDER BY s DESC) AS x0, lag(tp / ap, 1, 0) OVER (ORDER BY s DESC) AS y0 FROM c)
SELECT round(sum((x - x0) * (y + y0) / 2), 6) AS auc_roc FROM d""")
def _(spark, sf):
    return rounded(ev.roc_auc(scored6(spark, sf), "y", "s"), places=6)


@query("pr_curve", "A21 W8", CURVE_SQL + """
SELECT s AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / ap, 6) AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0""")
def _(spark, sf):
    return rounded(ev.pr_curve(scored6(spark, sf), "y", "s"), places=6)


@query("pr_auc", "A21", CURVE_SQL + """,
d AS (SELECT tp / ap AS x, tp / (tp + fp) AS y, lag(tp / ap, 1, 0) OVER (ORDER BY s DESC) AS x0, lag(tp / (tp + fp), 1, 1) OVER (ORDER BY s DESC) AS y0 FROM c)
SELECT round(sum((x - x0) * (y + y0) / 2), 6) AS auc_pr FROM d""")
def _(spark, sf):
    return rounded(ev.pr_auc(scored6(spark, sf), "y", "s"), places=6)


PRICE_SQL = """
  SELECT l_extendedprice AS y, l_quantity * 2000.0 AS p,
    CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 'reference' ELSE 'current' END AS side FROM lineitem"""


def prices(spark, sf):
    side = F.when(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"), "reference").otherwise("current")
    return table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000.0).alias("p"), side.alias("side"))


@query("regression_metrics", "A22 A23", f"""
WITH t AS ({PRICE_SQL}) SELECT round(avg((y - p) * (y - p)), 2) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
  round(avg(abs(y - p)), 4) AS mae, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2,
  round(1 - var_pop(y - p) / var_pop(y), 6) AS explained_variance, round(avg(y - p), 4) AS residual_mean,
  round(stddev_pop(y - p), 4) AS residual_std FROM t""")
def _(spark, sf):
    out = ev.regression_metrics(prices(spark, sf), "y", "p")
    out = rounded(rounded(out, "mse", places=2), "rmse", "mae", "residual_mean", "residual_std", places=4)
    return rounded(out, "r2", "explained_variance", places=6)


@query("error_percentiles", "A23", f"""
WITH t AS ({PRICE_SQL}) SELECT round(quantile_cont(abs(y - p), 0.5), 4) AS median_absolute_error,
  round(quantile_cont(abs(y - p), 0.9), 4) AS percentile_90_error, round(quantile_cont(abs(y - p), 0.95), 4) AS percentile_95_error FROM t""")
def _(spark, sf):
    return rounded(ev.error_percentiles(prices(spark, sf), "y", "p"))


def weights_sql(rows: str, keys: str, draws: int, by: str) -> str:
    """Poisson(1) weights per row and draw, as in ``weighted_draws``, and their sums by ``by``: rows with equal keys are numbered."""
    bounds, size, many = ev.weight_bounds(), ev.WEIGHT_DIGITS, ev.WEIGHTS_A_DIGEST
    name = " || '-' || ".join(f"coalesce({k.strip()}::VARCHAR, '\\N')" for k in keys.split(","))
    cases = " ".join(f"WHEN u < '{b}' THEN {w}" for w, b in enumerate(bounds))
    return f"""
r AS (SELECT {by}, {name} || '-' || row_number() OVER (PARTITION BY {keys}) AS name FROM {rows}),
h AS (SELECT {by}, block, sha256(name || '-' || block || '-42') AS h FROM r, range({-(-draws // many)}) b(block)),
u AS (SELECT {by}, block * {many} + place + 1 AS draw, substr(h, 1 + {size} * place::INT, {size}) AS u FROM h, range({many}) k(place)),
w AS (SELECT {by}, draw, sum(CASE {cases} ELSE {len(bounds)} END) AS w FROM u WHERE draw <= {draws} GROUP BY ALL)"""


def _interval_sql(metrics):
    return tall(*[f"""SELECT '{m}' AS metric, round(avg({m}), 6) AS mean, round(stddev_pop({m}), 6) AS std,
      round(quantile_cont({m}, 0.025), 6) AS lower, round(quantile_cont({m}, 0.975), 6) AS upper FROM x""" for m in metrics])


@query("bootstrap_classification", "A24", f"""
WITH t AS (SELECT l.doc_id, l.quality AS y, (d.n_chars > 1500)::INT AS p FROM labels l JOIN documents d USING (doc_id)), {weights_sql('t', 'doc_id, y, p', 1000, 'y, p')},
l AS (SELECT draw, y AS label, w AS s, 0 AS f, CASE WHEN y = p THEN w ELSE 0 END AS t FROM w WHERE w > 0
      UNION ALL SELECT draw, p, 0, w, 0 FROM w WHERE w > 0),
c AS (SELECT draw, label, sum(s) AS s, sum(f) AS f, sum(t) AS t FROM l GROUP BY ALL),
x AS (SELECT draw, sum(t) / sum(s) AS accuracy, sum(s * coalesce(2.0 * t / nullif(f + s, 0), 0)) / sum(s) AS f1 FROM c GROUP BY 1)
{_interval_sql(('accuracy', 'f1'))}""")
def _(spark, sf):
    both = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    df = both.select("doc_id", F.col("quality").alias("y"), (F.col("n_chars") > 1500).cast("int").alias("p"))
    return rounded(ev.bootstrap_classification(df, "y", "p", 1000, key=["doc_id"]), places=6)


@query("bootstrap_regression", "A24", f"""
WITH t AS (SELECT c_acctbal AS y, c_nationkey * 300.0::DOUBLE + 1000 AS p FROM customer),
c0 AS (SELECT y, p, count(*) AS n FROM t WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY 1, 2),
lo AS (SELECT DISTINCT n, greatest(0, floor(n - 9 * sqrt(n) - 20))::BIGINT AS low, ceil(n + 9 * sqrt(n) + 20)::BIGINT AS high FROM c0),
k AS (SELECT n, low, unnest(range(low, high + 1)) AS k FROM lo),
s AS (SELECT n, low, k, sum(exp(k * ln(n) - n - lgamma(k + 1))) OVER (PARTITION BY n ORDER BY k) AS f FROM k),
f AS (SELECT n, low, list(f ORDER BY k) AS f FROM s GROUP BY 1, 2),
d AS (SELECT y, p, n, draw, ('0x' || substr(md5(y || '-' || p || '-' || draw || '-42'), 1, 15))::BIGINT / 1152921504606846976.0 AS u FROM c0, range(1, 201) b(draw)),
w AS (SELECT draw, y - (SELECT sum(n * y) / sum(n) FROM c0) AS y, (y - p) * (y - p) AS e, low + len(list_filter(f, lambda x: x < u)) AS w FROM d JOIN f USING (n)),
g AS (SELECT draw, sum(w) AS n, sum(w * e) AS e, sum(w * y) AS s, sum(w * y * y) AS q FROM w GROUP BY 1),
x AS (SELECT draw, sqrt(e / n) AS rmse, 1 - e / (q - s * s / n) AS r2 FROM g)
{_interval_sql(('rmse', 'r2'))}""")
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_acctbal", (F.col("c_nationkey") * 300.0 + 1000).alias("p"))
    return rounded(ev.bootstrap_regression(df, "c_acctbal", "p", 200), places=6)


@query("fold_score_summary", "A39 M22", """
WITH f AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
  (row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || '-42'), o_orderkey) - 1) % 5 AS fold FROM orders),
s AS (SELECT fold, 'accuracy' AS metric, avg((o_orderstatus = CASE WHEN o_totalprice > 250000 THEN 'F' ELSE 'O' END)::INT) AS value FROM f GROUP BY 1
  UNION ALL SELECT fold, 'price', avg(o_totalprice) FROM f GROUP BY 1)
SELECT metric, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std FROM s GROUP BY 1""")
def _(spark, sf):
    from opspark.operators.prepare import folds

    f = folds(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus")
    hit = F.col("o_orderstatus") == F.when(F.col("o_totalprice") > 250000, "F").otherwise("O")
    per = f.groupBy("fold").agg(F.avg(hit.cast("double")).alias("accuracy"), F.avg("o_totalprice").alias("price"))
    long = per.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")),
        F.struct(F.lit("price").alias("metric"), F.col("price").alias("value")))).alias("r")).select("r.*")
    return rounded(ev.score_summary(long))


# -- drift -------------------------------------------------------------------

DRIFT_COLS = ["quantity", "price", "discount"]
SIDES_SQL = """
  SELECT l_quantity AS quantity, l_extendedprice * CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 1.0 ELSE 1.2 END AS price,
    CASE WHEN l_linenumber <> 3 THEN l_discount END AS discount,
    CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END AS side FROM lineitem"""
LONG_SQL = f"s AS ({SIDES_SQL}), v AS (" + tall(*[
    f"SELECT '{c}' AS feature, {c} AS v, side FROM s WHERE {c} IS NOT NULL" for c in DRIFT_COLS]) + ")"


def halves(spark, sf):
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    df = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"), (F.col("l_extendedprice") * F.when(early, 1.0).otherwise(1.2)).alias("price"),
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("discount"), early.alias("early"))
    return df.where("early").drop("early"), df.where("not early").drop("early")


ECDF_SQL = f"""WITH {LONG_SQL},
g AS (SELECT feature, v, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c FROM v GROUP BY 1, 2),
e AS (SELECT feature, v, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) AS f, sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS g,
  lead(v) OVER w AS nxt FROM g WINDOW w AS (PARTITION BY feature ORDER BY v))"""


@query("drift_ks", "A25 P5 J6 U1 W8", ECDF_SQL + " SELECT feature, round(max(abs(f - g)), 6) AS score FROM e GROUP BY 1")
def _(spark, sf):
    return rounded(dr.drift_scores(*halves(spark, sf), method="ks"), places=6)


@query("drift_wasserstein", "A27", ECDF_SQL + " SELECT feature, round(sum(abs(f - g) * (nxt - v)), 4) AS score FROM e GROUP BY 1")
def _(spark, sf):
    return rounded(dr.drift_scores(*halves(spark, sf), method="wasserstein"))


@query("drift_chi_square", "A26 X13", f"""
WITH {LONG_SQL}, b AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM v GROUP BY 1),
c AS (SELECT feature, least(floor((v - lo) / ((hi - lo) / 10.0)), 9) AS bin, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c
  FROM v JOIN b USING (feature) GROUP BY 1, 2),
e AS (SELECT feature, r, (r + c) / 2.0 + 1e-10 AS e FROM c)
SELECT feature, round(sum((r - e) * (r - e) / e) / 11, 4) AS score FROM e GROUP BY 1""")
def _(spark, sf):
    return rounded(dr.drift_scores(*halves(spark, sf), method="chi2"))


PSI_SQL = f"""
WITH {LONG_SQL}, b AS (SELECT feature, min(v) FILTER (side = 0) AS lo, max(v) FILTER (side = 0) AS hi,
    count(*) FILTER (side = 0) AS nr, count(*) FILTER (side = 1) AS nc FROM v GROUP BY 1),
c AS (SELECT feature, least(floor((v - lo) / ((hi - lo) / 10.0)), 9)::INT AS bin, side FROM v JOIN b USING (feature) WHERE v BETWEEN lo AND hi),
g AS (SELECT feature, k::INT AS bin, nr, nc FROM b, range(10) r(k)),
p AS (SELECT g.feature, g.bin, (count(*) FILTER (c.side = 0) + 1.0) / (any_value(nr) + 10) AS r,
    (count(*) FILTER (c.side = 1) + 1.0) / (any_value(nc) + 10) AS q FROM g LEFT JOIN c ON c.feature = g.feature AND c.bin = g.bin GROUP BY 1, 2),
z AS (SELECT feature, sum((q - r) * ln(q / r)) AS score FROM p GROUP BY 1)"""


@query("drift_psi", "A28 X13 X6", PSI_SQL + " SELECT feature, round(score, 6) AS score FROM z")
def _(spark, sf):
    return rounded(dr.drift_scores(*halves(spark, sf), method="psi"), places=6)


@query("drift_verdict", "A29", PSI_SQL + """
SELECT coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (score > 0.01), '') AS drifted_features,
  count(*) FILTER (score > 0.01) AS drifted, count(*) FILTER (score > 0.01) > 0 AS overall_drift,
  round(count(*) FILTER (score > 0.01) / 3.0, 6) AS drift_percentage,
  CASE WHEN count(*) FILTER (score > 0.01) = 0 THEN 'none' WHEN count(*) FILTER (score > 0.01) / 3.0 > 0.5 THEN 'high' ELSE 'medium' END AS severity
FROM z""")
def _(spark, sf):
    return rounded(dr.drift_verdict(dr.drift_scores(*halves(spark, sf), method="psi"), 3, 0.01), places=6)


RECENT_SQL = """
WITH l AS (SELECT *, row_number() OVER (ORDER BY ts DESC) AS r, count(*) OVER () AS n FROM events),
s AS (SELECT *, CASE WHEN r <= 50 THEN 1 ELSE 0 END AS side FROM l WHERE r <= 100 AND n >= 100)"""


@query("last_windows", "W1 P10", RECENT_SQL + " SELECT event_id, value, side FROM s")
def _(spark, sf):
    return dr.last_windows(table(spark, sf, "events"), "ts", 50).select("event_id", "value", "side")


def recent_sql():
    p = " + ".join(f"{2.0 * (-1) ** (j - 1)} * exp({-2.0 * j * j} * lam * lam)" for j in range(1, 21))
    return RECENT_SQL + f""",
    v AS (SELECT 'user_id' AS feature, user_id::DOUBLE AS v, side FROM s UNION ALL SELECT 'value', value, side FROM s),
    g AS (SELECT feature, v, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c FROM v GROUP BY 1, 2),
    e AS (SELECT feature, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) AS f, sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS g
      FROM g WINDOW w AS (PARTITION BY feature ORDER BY v)),
    k AS (SELECT feature, sqrt(50.0 * 50 / 100) * max(abs(f - g)) AS lam FROM e GROUP BY 1),
    p AS (SELECT CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, {p})) END AS p FROM k)
    SELECT count(*) FILTER (p < 0.05) AS drifted_columns, count(*) FILTER (p < 0.05) / 2.0 AS drift_share,
      CASE WHEN count(*) FILTER (p < 0.05) >= 1 THEN 1.0 ELSE 0.0 END AS drift_flag FROM p"""


@query("recent_drift_flag", "A30 W1", recent_sql())
def _(spark, sf):
    return dr.recent_drift(table(spark, sf, "events").select("ts", "user_id", "value"), "ts", ["user_id", "value"])


@query("accuracy_degradation", "A31", f"""
WITH u AS ({CLASS_SQL}), k AS (SELECT side, y, p, count(*) AS n FROM u GROUP BY ALL),
l AS (SELECT side, y AS v, n AS s, 0 AS f, CASE WHEN y = p THEN n ELSE 0 END AS t FROM k UNION ALL SELECT side, p, 0, n, 0 FROM k),
c AS (SELECT side, v, sum(s) AS s, sum(f) AS f, sum(t) AS t FROM l GROUP BY ALL),
m AS (SELECT side, sum(t) / sum(s) AS a, sum(s * coalesce(2.0 * t / nullif(f + s, 0), 0)) / sum(s) AS f1 FROM c GROUP BY 1)
SELECT round(r.a, 6) AS reference_accuracy, round(c.a, 6) AS current_accuracy, round(r.a - c.a, 6) AS accuracy_drop,
  round(r.f1 - c.f1, 6) AS f1_drop, r.a - c.a > 0.05 AS alert FROM m r, m c WHERE r.side = 'reference' AND c.side = 'current'""")
def _(spark, sf):
    return rounded(dr.accuracy_drop(classes(spark, sf), "side", "y", "p"), places=6)


@query("error_degradation", "A31", f"""
WITH t AS ({PRICE_SQL}), m AS (SELECT avg((y - p) * (y - p)) FILTER (side = 'reference') AS r, avg((y - p) * (y - p)) FILTER (side = 'current') AS c FROM t)
SELECT round(r, 2) AS reference_mse, round(c, 2) AS current_mse, round((c - r) / r, 6) AS mse_increase, (c - r) / r > 0.1 AS alert FROM m""")
def _(spark, sf):
    out = dr.error_increase(prices(spark, sf), "side", "y", "p")
    return rounded(rounded(out, "mse_increase", places=6), "reference_mse", "current_mse", places=2)
