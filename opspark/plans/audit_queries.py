"""Queries on policies, compliance, evidence, lineage and traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.operators import evidence as evd, lineage as ln, policy as po
from opspark.plans.feature_queries import rounded
from opspark.plans.registry import query, table
from opspark.plans.table_queries import tall
from opspark.session import spread
from opspark.sources.schemas import POD

# A workload resource per order line: kind and names by rule from its columns.
KINDS = ["Deployment", "StatefulSet", "DaemonSet", "ReplicaSet", "Pod", "Job", "CronJob", "Service"]
SPACES = ["default", "kube-system", "team-a", "istio-system", "production-public"]
LINE_SQL = f"""
  SELECT row_number() OVER () AS rid, (l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey) AS name,
    [{', '.join(f"'{k}'" for k in KINDS)}][(l_partkey % 8)::INT + 1] AS kind,
    [{', '.join(f"'{s}'" for s in SPACES)}][(l_suppkey % 5)::INT + 1] AS namespace,
    CASE WHEN l_linenumber = 1 THEN 'istio-proxy' WHEN l_linenumber = 2 THEN 'vault-agent' ELSE 'app' || l_linenumber END AS cname,
    CASE WHEN l_linestatus = 'O' THEN 'k8s.gcr.io/' ELSE 'hub/' END || 'image' || (l_partkey % 50) ||
      CASE WHEN l_returnflag = 'R' THEN ':latest' ELSE ':1.' || l_linenumber END AS image,
    'init' || (l_suppkey % 3) AS iname, 'hub/init' || (l_suppkey % 7) || CASE WHEN l_discount > 0.05 THEN ':latest' ELSE ':2' END AS iimage,
    CASE WHEN l_quantity > 10 THEN '1' END AS lim_cpu, CASE WHEN l_quantity > 20 THEN '2Gi' END AS lim_mem,
    CASE WHEN l_quantity > 30 THEN '1' END AS req_cpu, CASE WHEN l_quantity > 40 THEN '1Gi' END AS req_mem,
    CASE WHEN l_tax < 0.03 THEN '1Gi' END AS lim_disk,
    l_tax > 0.06 AS privileged, l_tax > 0.04 AS escalation, CASE WHEN l_tax > 0.01 THEN l_tax < 0.05 END AS non_root,
    CASE WHEN l_discount > 0.02 THEN l_discount > 0.06 END AS read_only, CASE WHEN l_discount < 0.03 THEN l_quantity::BIGINT % 3 END AS uid,
    CASE WHEN l_discount = 0.04 THEN 'CAP_SYS_ADMIN' WHEN l_discount = 0.05 THEN 'CAP_CHOWN' END AS cap,
    CASE WHEN l_discount > 0.04 THEN 'ALL' ELSE 'NET_RAW' END AS dropped, CASE WHEN l_tax = 0.02 THEN 'RuntimeDefault' WHEN l_tax = 0.03 THEN 'Unconfined' END AS seccomp,
    l_discount = 0.01 AS host_network, l_discount = 0.02 AS host_pid, CASE WHEN l_discount = 0.03 THEN true END AS host_ipc,
    CASE WHEN l_tax = 0.0 THEN 'hostPath' WHEN l_tax = 0.01 THEN 'csi' ELSE 'emptyDir' END AS volume,
    CASE WHEN l_quantity < 25 THEN 'LoadBalancer' ELSE 'ClusterIP' END AS stype,
    CASE WHEN l_tax < 0.02 THEN 'aws' WHEN l_tax < 0.04 THEN 'gcp' WHEN l_tax < 0.06 THEN 'azure' ELSE 'none' END AS cloud,
    l_quantity < 12 AS noted
  FROM lineitem"""


def resources(spark, sf):
    """The same resources as nested documents, read through the resource schema."""
    li = spread(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"))
    c, q, d, t = F.col, F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")

    def pick(names, index):
        return F.element_at(F.array(*map(F.lit, names)), index.cast("int") + 1)

    kind = pick(KINDS, c("l_partkey") % 8)
    n = c("l_linenumber").cast("string")
    image = F.concat(F.when(c("l_linestatus") == "O", "k8s.gcr.io/").otherwise("hub/"), F.lit("image"),
                     (c("l_partkey") % 50).cast("string"),
                     F.when(c("l_returnflag") == "R", ":latest").otherwise(F.concat(F.lit(":1."), n)))
    cname = F.when(c("l_linenumber") == 1, "istio-proxy").when(c("l_linenumber") == 2, "vault-agent").otherwise(
        F.concat(F.lit("app"), n))
    def some(*pairs):
        made = F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v in pairs]))
        return F.map_from_entries(made)

    limits = some(("cpu", F.when(q > 10, "1")), ("memory", F.when(q > 20, "2Gi")), ("ephemeral-storage", F.when(t < 0.03, "1Gi")))
    asked = some(("cpu", F.when(q > 30, "1")), ("memory", F.when(q > 40, "1Gi")))
    security = F.struct(
        (t > 0.06).alias("privileged"), (t > 0.04).alias("allowPrivilegeEscalation"), F.when(t > 0.01, t < 0.05).alias("runAsNonRoot"),
        F.when(d > 0.02, d > 0.06).alias("readOnlyRootFilesystem"), F.when(d < 0.03, q.cast("bigint") % 3).alias("runAsUser"),
        F.struct(F.array_compact(F.array(F.when(d == 0.04, "CAP_SYS_ADMIN").when(d == 0.05, "CAP_CHOWN"))).alias("add"),
                 F.array(F.when(d > 0.04, "ALL").otherwise("NET_RAW")).alias("drop")).alias("capabilities"),
        F.struct(F.when(t == 0.02, "RuntimeDefault").when(t == 0.03, "Unconfined").alias("type")).alias("seccompProfile"))
    main = F.struct(cname.alias("name"), image.alias("image"),
                    F.struct(limits.alias("limits"), asked.alias("requests")).alias("resources"), security.alias("securityContext"))
    init = F.struct(
        F.concat(F.lit("init"), (c("l_suppkey") % 3).cast("string")).alias("name"),
        F.concat(F.lit("hub/init"), (c("l_suppkey") % 7).cast("string"), F.when(d > 0.05, ":latest").otherwise(":2")).alias("image"),
        F.struct(limits.alias("limits"), asked.alias("requests")).alias("resources"), security.alias("securityContext"))
    pod = F.struct(
        (d == 0.01).alias("hostNetwork"), (d == 0.02).alias("hostPID"), F.when(d == 0.03, True).alias("hostIPC"),
        F.array(F.create_map(F.when(t == 0.0, "hostPath").when(t == 0.01, "csi").otherwise("emptyDir"), F.lit("x"))).alias("volumes"),
        F.array(main).alias("containers"), F.array(init).alias("initContainers"))
    direct, nested = kind == "Pod", kind == "CronJob"
    in_template = ~kind.isin("Pod", "CronJob", "Service")
    spec = F.struct(
        F.when(kind == "Service", F.when(q < 25, "LoadBalancer").otherwise("ClusterIP")).alias("type"),
        *[F.when(direct, pod[f]).alias(f) for f in POD.fieldNames()],
        F.when(in_template, F.struct(pod.alias("spec"))).alias("template"),
        F.when(nested, F.struct(F.struct(F.struct(pod.alias("spec")).alias("template")).alias("spec"))).alias("jobTemplate"))
    note = F.when(t < 0.02, po.AWS_INTERNAL).when(t < 0.04, po.GCP_INTERNAL).when(t < 0.06, po.AZURE_INTERNAL).otherwise("none")
    value = F.when((t >= 0.02) & (t < 0.04), "Internal").otherwise("true")
    notes = F.when(q < 12, F.create_map(note, value))
    name = F.concat_ws("-", *[c(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    meta = F.struct(name.alias("name"), pick(SPACES, c("l_suppkey") % 5).alias("namespace"), notes.alias("annotations"))
    return li.select(kind.alias("kind"), meta.alias("metadata"), spec.alias("spec"))


WORK_SQL = f"""t AS MATERIALIZED (SELECT * FROM ({LINE_SQL}) WHERE namespace <> 'kube-system')"""


def heads(*parts):
    """Union of (condition, message) heads; equal messages of a resource once."""
    union = " UNION ".join(f"SELECT rid, kind, namespace, name AS resource, {m} AS msg FROM t WHERE {w}" for w, m in parts)
    return f"SELECT kind, namespace, resource, msg FROM ({union})"


def q(text):
    return "'" + text.replace("'", "''") + "'"


def message(template, *values):
    parts = template.split("%s")
    out = [q(parts[0])]
    for v, p in zip(values, parts[1:]):
        out += [v, q(p)]
    return " || ".join(out)


LATEST_HEADS = heads(
    ("kind IN ('Deployment','StatefulSet','DaemonSet','ReplicaSet','Job') AND image LIKE '%:latest' AND image NOT LIKE '%k8s.gcr.io/%'",
     message(po.LATEST_MESSAGE, "'Container'", "image")),
    ("kind IN ('Deployment','StatefulSet','DaemonSet','ReplicaSet','Job') AND iimage LIKE '%:latest'",
     message(po.LATEST_MESSAGE, "'Init container'", "iimage")),
    ("kind = 'Pod' AND image LIKE '%:latest' AND image NOT LIKE '%k8s.gcr.io/%'", message(po.LATEST_MESSAGE, "'Pod container'", "image")),
    ("kind = 'Pod' AND iimage LIKE '%:latest'", message(po.LATEST_MESSAGE, "'Pod init container'", "iimage")),
    ("kind = 'Job' AND image LIKE '%:latest' AND image NOT LIKE '%k8s.gcr.io/%'", message(po.LATEST_MESSAGE, "'Job container'", "image")),
    ("kind = 'CronJob' AND image LIKE '%:latest' AND image NOT LIKE '%k8s.gcr.io/%'", message(po.LATEST_MESSAGE, "'CronJob container'", "image")))

LIMIT_HEADS = heads(*[
    (f"kind <> 'Service' AND {col} IS NULL{extra}", message(po.LIMIT_MESSAGES[path], f"'{title}'", who))
    for title, who, extra in (("Container", "cname", " AND cname <> 'istio-proxy'"), ("Init container", "iname", ""))
    for path, col in (("limits.cpu", "lim_cpu"), ("limits.memory", "lim_mem"), ("requests.cpu", "req_cpu"), ("requests.memory", "req_mem"))])

BALANCER_WHERE = """kind = 'Service' AND stype = 'LoadBalancer' AND NOT (noted AND cloud IN ('aws', 'gcp', 'azure'))
  AND namespace NOT IN ('istio-system', 'production-public')"""
BALANCER_HEADS = heads((BALANCER_WHERE, message(po.BALANCER_MESSAGE, "name", "namespace")))

_C = "kind <> 'Service' AND cname <> 'vault-agent' AND "
BASELINE = [
    ("kind <> 'Service' AND host_network", q(po.HOST_MESSAGE % "hostNetwork")),
    ("kind <> 'Service' AND host_pid", q(po.HOST_MESSAGE % "hostPID")),
    ("kind <> 'Service' AND host_ipc", q(po.HOST_MESSAGE % "hostIPC")),
    (_C + "privileged", message(po.PRIVILEGED_MESSAGE, "'Container'", "cname")),
    (_C + "escalation", message(po.ESCALATION_MESSAGE, "cname")),
    (_C + "cap = 'CAP_SYS_ADMIN'", message(po.CAPABILITY_MESSAGE, "cname", "cap")),
    ("kind <> 'Service' AND privileged", message(po.PRIVILEGED_MESSAGE, "'Init container'", "iname")),
]
RESTRICTED = BASELINE + [
    (_C + "NOT coalesce(non_root, false)", message(po.NON_ROOT_MESSAGE, "'Container'", "cname")),
    (_C + "uid = 0", message(po.ROOT_USER_MESSAGE, "cname")),
    (_C + "dropped <> 'ALL'", message(po.DROP_ALL_MESSAGE, "cname")),
    (_C + "NOT coalesce(read_only, false)", message(po.READ_ONLY_MESSAGE, "cname")),
    (_C + "coalesce(seccomp, '') NOT IN ('RuntimeDefault', 'Localhost')", message(po.SECCOMP_MESSAGE, "cname")),
    ("kind <> 'Service' AND NOT coalesce(non_root, false)", message(po.NON_ROOT_MESSAGE, "'Init container'", "iname")),
    ("kind <> 'Service' AND volume IN ('hostPath', 'csi')", message(po.VOLUME_MESSAGE, "volume")),
]


@query("deny_latest_images", "D2 D3 X7 X8 Y4", f"WITH {WORK_SQL}, h AS ({LATEST_HEADS}) SELECT *, 'deny_latest' AS rule, 'deny' AS action FROM h")
def _(spark, sf):
    return po.deny_latest(resources(spark, sf))


@query("require_limits", "D2 D4 X8 X12", f"WITH {WORK_SQL}, h AS ({LIMIT_HEADS}) SELECT *, 'require_limits' AS rule, 'deny' AS action FROM h")
def _(spark, sf):
    return po.require_limits(resources(spark, sf))


@query("require_disk_limits", "D4", f"""WITH {WORK_SQL}, h AS (
{heads(("kind <> 'Service' AND lim_disk IS NULL AND cname <> 'istio-proxy'", message(po.LIMIT_MESSAGES['limits.ephemeral-storage'], "'Container'", "cname")))})
SELECT namespace, count(*) AS violations FROM h GROUP BY 1""")
def _(spark, sf):
    found = po.require_limits(resources(spark, sf), requests=False, ephemeral=True)
    return found.where(F.col("msg").contains("ephemeral-storage")).groupBy("namespace").agg(F.count("*").alias("violations"))


@query("block_public_balancers", "D2 D5 J10 X11", f"WITH {WORK_SQL}, h AS ({BALANCER_HEADS}) SELECT *, 'block_public_lb' AS rule, 'deny' AS action FROM h")
def _(spark, sf):
    return po.block_public_balancer(resources(spark, sf))


@query("pod_security_baseline", "D6 X10", f"WITH {WORK_SQL}, h AS ({heads(*BASELINE)}) SELECT *, 'pod_security' AS rule, 'deny' AS action FROM h")
def _(spark, sf):
    return po.pod_security(resources(spark, sf), "baseline")


@query("pod_security_restricted", "D7 X10 X12", f"WITH {WORK_SQL}, h AS ({heads(*RESTRICTED)}) SELECT *, 'pod_security' AS rule, 'deny' AS action FROM h")
def _(spark, sf):
    return po.pod_security(resources(spark, sf), "restricted")


@query("audit_summary", "U2 D2 J10", f"""
WITH {WORK_SQL}, a AS (SELECT 'deny_latest' AS rule, * FROM ({LATEST_HEADS}) UNION ALL SELECT 'require_limits', * FROM ({LIMIT_HEADS})
UNION ALL SELECT 'block_public_lb', * FROM ({BALANCER_HEADS}) UNION ALL SELECT 'pod_security', * FROM ({heads(*BASELINE)}))
SELECT rule, namespace, count(*) AS violations FROM (SELECT DISTINCT * FROM a) GROUP BY 1, 2""")
def _(spark, sf):
    return po.audit(resources(spark, sf)).groupBy("rule", "namespace").agg(F.count("*").alias("violations"))


@query("flattened_containers", "D1 X10", f"""
WITH t AS ({LINE_SQL}) SELECT kind, role, name, count(*) AS containers FROM (
  SELECT kind, 'container' AS role, cname AS name FROM t WHERE kind <> 'Service' UNION ALL SELECT kind, 'init', iname FROM t WHERE kind <> 'Service')
GROUP BY ALL""")
def _(spark, sf):
    return po.flatten_containers(resources(spark, sf)).groupBy("kind", "role", "name").agg(F.count("*").alias("containers"))


TOTALS_SQL = """SELECT o_custkey AS host, count(*) FILTER (o_orderstatus = 'F') AS total_pass, count(*) FILTER (o_orderstatus = 'O') AS total_fail,
  CASE WHEN o_custkey % 3 <> 0 THEN count(*) FILTER (o_orderstatus = 'P') END AS total_warn, CASE WHEN o_custkey % 7 = 0 THEN 12 END::BIGINT AS total_info
  FROM orders GROUP BY 1"""


def totals(spark, sf):
    s = F.col("o_orderstatus")
    t = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("host")).agg(
        F.count_if(s == "F").alias("total_pass"), F.count_if(s == "O").alias("total_fail"), F.count_if(s == "P").alias("w"))
    return t.select("host", "total_pass", "total_fail", F.when(F.col("host") % 3 != 0, F.col("w")).alias("total_warn"),
                    F.when(F.col("host") % 7 == 0, 12).cast("bigint").alias("total_info"))


SCORE_SQL = """c AS (SELECT {0} sum(coalesce(total_pass, 0))::BIGINT AS total_pass, sum(coalesce(total_fail, 0))::BIGINT AS total_fail,
  sum(coalesce(total_warn, 0))::BIGINT AS total_warn, sum(coalesce(total_info, 0))::BIGINT AS total_info FROM t {1}),
s AS (SELECT *, total_pass + total_fail + total_warn + total_info AS total_checks,
  round(coalesce(total_pass::DOUBLE / nullif(total_pass + total_fail + total_warn + total_info, 0)::DOUBLE * 100, 0), 1) AS compliance_score FROM c)
SELECT *, CASE WHEN compliance_score >= 90 THEN 'COMPLIANT' WHEN compliance_score >= 70 THEN 'PARTIALLY COMPLIANT' ELSE 'NON-COMPLIANT' END AS status FROM s"""


@query("compliance_by_host", "A36 D8 X5 X12", f"WITH t AS ({TOTALS_SQL}), " + SCORE_SQL.format("host,", "GROUP BY host"))
def _(spark, sf):
    return po.compliance_score(totals(spark, sf), ["host"])


@query("compliance_total", "A36 D8", f"WITH t AS ({TOTALS_SQL}), " + SCORE_SQL.format("", ""))
def _(spark, sf):
    return po.compliance_score(totals(spark, sf))


@query("critical_failures", "T2 D8 X8", """
SELECT id, '- [' || id || '] ' || text AS line FROM (
SELECT lpad(o_orderkey::VARCHAR, 8, '0') AS id, o_orderpriority AS text FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000)
ORDER BY id, text LIMIT 10""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    checks = o.select(F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("id"), F.col("o_orderpriority").alias("text"),
                      F.when(F.col("o_orderstatus") == "O", "FAIL").otherwise("PASS").alias("state"),
                      (F.col("o_totalprice") > 100000).alias("scored"))
    return po.failed_checks(checks, 10)


# -- evidence -------------------------------------------------------------------

EVIDENCE_SQL = """
  SELECT doc_id, strftime(TIMESTAMP '2024-01-01' + to_days(doc_id::INT % 28), '%Y-%m-%dT%H:%M:%SZ') AS timestamp, md5(doc_id::VARCHAR) AS "commit",
    doc_id::VARCHAR AS run_id, sha256(text) AS terraform_hash, CASE WHEN doc_id % 3 = 0 THEN 'sha256:' || source ELSE '' END AS image_digest,
    '1.0' AS evidence_version, 'RSASSA_PKCS1_V1_5_SHA_256' AS signing_algorithm FROM documents"""


def records(spark, sf):
    docs = table(spark, sf, "documents")
    day = F.date_format(F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") % 28) * 86400), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return evd.assemble(docs, day, F.md5(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id"), F.col("text"),
                        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("sha256:"), F.col("source"))), keep=["doc_id"])


@query("evidence_records", "D9 X9 X12", EVIDENCE_SQL)
def _(spark, sf):
    return records(spark, sf)


CANON_SQL = """'{"commit": "' || "commit" || '", "evidence_version": "1.0", "image_digest": "' || image_digest || '", "run_id": "' || run_id ||
  '", "signing_algorithm": "RSASSA_PKCS1_V1_5_SHA_256", "terraform_hash": "' || terraform_hash || '", "timestamp": "' || timestamp || '"}'"""


@query("evidence_canonical_json", "X1 D9", f"WITH e AS ({EVIDENCE_SQL}) SELECT run_id, {CANON_SQL} AS body FROM e")
def _(spark, sf):
    return records(spark, sf).select("run_id", evd.canonical_json().alias("body"))


@query("evidence_signatures", "X9 D10", f"WITH e AS ({EVIDENCE_SQL}) SELECT run_id, to_base64(unhex(sha256({CANON_SQL}))) AS signature FROM e")
def _(spark, sf):
    return evd.sign(records(spark, sf)).select("run_id", "signature")


@query("evidence_tamper_check", "D10 J9", f"""
WITH e AS ({EVIDENCE_SQL}) SELECT substr(timestamp, 1, 10) AS date, run_id, CASE WHEN doc_id % 11 = 0 THEN 'missing_evidence' WHEN doc_id % 7 = 0 THEN 'missing_signature'
  WHEN doc_id % 5 = 0 THEN 'invalid' ELSE 'valid' END AS status FROM e WHERE NOT (doc_id % 11 = 0 AND doc_id % 7 = 0)""")
def _(spark, sf):
    rows = records(spark, sf).withColumn("date", F.substring("timestamp", 1, 10))
    signatures = evd.sign(rows).where("doc_id % 7 <> 0").select("date", "run_id", "signature")
    changed = F.when(F.col("doc_id") % 5 == 0, F.concat(F.col("commit"), F.lit("x"))).otherwise(F.col("commit"))
    return evd.verify(rows.where("doc_id % 11 <> 0").withColumn("commit", changed), signatures)


# -- lineage ---------------------------------------------------------------------

EDGE_SQL = """
  SELECT DISTINCT 'region ' || n_regionkey AS src, 'nation ' || n_nationkey AS dst FROM nation
  UNION SELECT 'nation ' || c_nationkey, 'customer ' || c_custkey FROM customer
  UNION SELECT 'customer ' || o_custkey, 'order ' || o_orderkey FROM orders
  UNION SELECT 'order ' || l_orderkey, 'supplier ' || l_suppkey FROM lineitem"""


def edges(spark, sf):
    def link(name, a, ka, b, kb):
        return table(spark, sf, name).select(F.concat(F.lit(a + " "), F.col(ka).cast("string")).alias("src"),
                                             F.concat(F.lit(b + " "), F.col(kb).cast("string")).alias("dst"))

    return (link("nation", "region", "n_regionkey", "nation", "n_nationkey")
            .unionByName(link("customer", "nation", "c_nationkey", "customer", "c_custkey"))
            .unionByName(link("orders", "customer", "o_custkey", "order", "o_orderkey"))
            .unionByName(link("lineitem", "order", "l_orderkey", "supplier", "l_suppkey")))


@query("lineage_edges", "D11", """
SELECT DISTINCT CASE WHEN event_type IN ('view', 'click') THEN 'data ' || (event_id % 500) ELSE 'task ' || event_type END AS src,
  CASE WHEN event_type IN ('view', 'click') THEN 'task ' || event_type ELSE 'data ' || (event_id % 500) END AS dst, user_id AS run_id FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.concat(F.lit("task "), "event_type").alias("task"),
        F.concat(F.lit("data "), (F.col("event_id") % 500).cast("string")).alias("dataset"),
        F.when(F.col("event_type").isin("view", "click"), "input").otherwise("output").alias("kind"))
    return ln.lineage_edges(e)


@query("lineage_downstream", "D12", f"""
WITH RECURSIVE e AS ({EDGE_SQL}), r AS (SELECT src AS root, dst AS node, 1 AS depth FROM e
  UNION SELECT r.root, e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node)
SELECT split_part(root, ' ', 1) AS kind, depth, count(*) AS pairs, count(DISTINCT node) AS nodes FROM (SELECT root, node, min(depth)::INT AS depth FROM r GROUP BY 1, 2) GROUP BY 1, 2""")
def _(spark, sf):
    found = ln.closure(edges(spark, sf))
    return found.groupBy(F.split_part("root", F.lit(" "), F.lit(1)).alias("kind"), "depth").agg(
        F.count("*").alias("pairs"), F.count_distinct("node").alias("nodes"))


@query("lineage_upstream_of_suppliers", "D12", f"""
WITH RECURSIVE e AS ({EDGE_SQL}), r AS (SELECT 'supplier ' || s_suppkey AS root, 'supplier ' || s_suppkey AS node, 0 AS depth FROM supplier
  UNION SELECT r.root, e.src, r.depth + 1 FROM r JOIN e ON e.dst = r.node)
SELECT root, min(depth)::INT AS depth, node FROM r WHERE depth > 0 GROUP BY root, node""")
def _(spark, sf):
    roots = table(spark, sf, "supplier").select(F.concat(F.lit("supplier "), F.col("s_suppkey").cast("string")).alias("root"))
    return ln.closure(edges(spark, sf), roots, upstream=True)


@query("job_listing", "D13", """
SELECT event_type AS job, count(*) AS runs, epoch_us(max(ts))::BIGINT AS last_run, arg_max(CASE WHEN value > 50 THEN 'FAIL' ELSE 'COMPLETE' END, ts) AS last_state
FROM events GROUP BY 1""")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("job"), "ts", F.when(F.col("value") > 50, "FAIL").otherwise("COMPLETE").alias("state"))
    return ln.job_listing(e).withColumn("last_run", F.unix_micros(F.col("last_run").cast("timestamp")))


@query("deploy_gate", "D14", """
SELECT o_orderkey, o_custkey AS run_id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def _(spark, sf):
    runs = table(spark, sf, "customer").select(F.col("c_custkey").alias("run_id"), (F.col("c_acctbal") > 0).alias("passed"))
    return ln.deploy_gate(table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("run_id")), runs)


@query("span_breakdown", "D15", """
WITH s AS (SELECT user_id AS trace_id, event_id::VARCHAR AS span_id, CASE WHEN event_id % 4 <> 0 THEN (event_id - event_id % 4)::VARCHAR END AS parent_id,
   event_type AS name, round(value, 0) AS took, event_id FROM events),
p AS (SELECT s.*, CASE WHEN q.event_id IS NOT NULL THEN s.parent_id END AS pid FROM s LEFT JOIN s q ON q.span_id = s.parent_id AND q.trace_id = s.trace_id),
i AS (SELECT trace_id, parent_id, sum(took) AS t FROM s WHERE parent_id IS NOT NULL GROUP BY 1, 2),
b AS (SELECT s.trace_id, s.name, count(*) AS spans, sum(s.took) AS total_time, sum(s.took - coalesce(i.t, 0)) AS self_time
   FROM s LEFT JOIN i ON i.trace_id = s.trace_id AND i.parent_id = s.span_id GROUP BY 1, 2)
SELECT trace_id, name, spans, total_time, self_time, round(self_time / nullif(sum(self_time) OVER (PARTITION BY trace_id), 0), 6) AS share FROM b""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("start", F.col("ts").cast("timestamp"))
    root = F.col("event_id") % 4
    spans = e.select(
        F.col("user_id").alias("trace_id"), F.col("event_id").cast("string").alias("span_id"),
        F.when(root != 0, (F.col("event_id") - root).cast("string")).alias("parent_id"), F.col("event_type").alias("name"), "start",
        F.timestamp_micros(F.unix_micros("start") + F.round("value", 0).cast("bigint") * 1_000_000).alias("end"))
    out = rounded(ln.span_breakdown(spans), "share", places=6)
    return rounded(out, "total_time", "self_time", places=0)


@query("url_and_text_digests", "X9 X7", """
SELECT page_id, sha256(html) AS digest, to_base64(encode(url)) AS url64, lower(url) LIKE '%ref=%' AS has_ref FROM pages""")
def _(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", F.sha2("html", 256).alias("digest"), F.base64(F.col("url").cast("binary")).alias("url64"),
                    F.lower("url").contains("ref=").alias("has_ref"))
