"""Audit rules over a table of workload resources.

Every rule gives the set of messages of a resource as an array expression over
that resource alone, so an audit is one projection without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opspark.session import cut_lineage
from opspark.sources.schemas import CONTAINER

# Kinds, namespaces, exemptions, annotations, capability and volume
# names, and message formats of the audited rules.
WORKLOAD_KINDS = ["Deployment", "DaemonSet", "StatefulSet", "ReplicaSet", "Pod", "Job", "CronJob"]
TEMPLATE_KINDS = ["Deployment", "ReplicaSet", "DaemonSet", "StatefulSet", "Job"]
SYSTEM_NAMESPACES = ["kube-system", "kube-public", "kube-node-lease", "gatekeeper-system"]
STANDARDS_NAMESPACES = ["kube-system", "kube-public", "kube-node-lease", "gatekeeper-system", "cert-manager"]
BALANCER_NAMESPACES = ["kube-system", "kube-public", "ingress-nginx", "istio-system"]
PUBLIC_NAMESPACES = ["production-public"]
EXEMPT_IMAGES = ["gcr.io/google_containers/", "k8s.gcr.io/", "docker.io/istio/"]
LIMIT_EXEMPT_CONTAINERS = ["istio-proxy", "linkerd-proxy"]
STANDARDS_EXEMPT_CONTAINERS = ["istio-init", "linkerd-init", "vault-agent"]
AWS_INTERNAL = "service.beta.kubernetes.io/aws-load-balancer-internal"
GCP_INTERNAL = "networking.gke.io/load-balancer-type"
GCP_LEGACY_INTERNAL = "cloud.google.com/load-balancer-type"
AZURE_INTERNAL = "service.beta.kubernetes.io/azure-load-balancer-internal"
DANGEROUS_CAPABILITIES = ["CAP_SYS_ADMIN", "CAP_NET_ADMIN", "CAP_SYS_TIME", "CAP_SYS_MODULE", "CAP_DAC_READ_SEARCH"]
RESTRICTED_VOLUMES = [
    "hostPath", "nfs", "iscsi", "glusterfs", "rbd", "flexVolume", "cinder", "cephfs", "flocker", "fc", "azureFile",
    "vsphereVolume", "quobyte", "azureDisk", "portworxVolume", "scaleIO", "storageos", "csi",
]
SECCOMP_PROFILES = ["RuntimeDefault", "Localhost"]
LATEST_MESSAGE = "%s image '%s' uses ':latest' tag. Use specific version tags for production stability."
LIMIT_MESSAGES = {
    "limits.cpu": "%s '%s' is missing CPU limits. Set resources.limits.cpu to ensure predictable performance.",
    "limits.memory": "%s '%s' is missing memory limits. Set resources.limits.memory to prevent OOM kills.",
    "requests.cpu": "%s '%s' is missing CPU requests. Set resources.requests.cpu for proper scheduling.",
    "requests.memory": "%s '%s' is missing memory requests. Set resources.requests.memory for proper scheduling.",
    "limits.ephemeral-storage": "%s '%s' is missing ephemeral-storage limits. "
                                "Set resources.limits.ephemeral-storage to prevent disk exhaustion.",
}
BALANCER_MESSAGE = (
    "LoadBalancer service '%s' in namespace '%s' must have an internal annotation. Add one of: "
    "service.beta.kubernetes.io/aws-load-balancer-internal=true (AWS), networking.gke.io/load-balancer-type=Internal "
    "(GCP), or service.beta.kubernetes.io/azure-load-balancer-internal=true (Azure)"
)
HOST_MESSAGE = "Pod uses %s which is not allowed in baseline security level"
PRIVILEGED_MESSAGE = "%s '%s' is privileged which is not allowed in baseline security level"
ESCALATION_MESSAGE = "Container '%s' allows privilege escalation which is not allowed in baseline security level"
CAPABILITY_MESSAGE = "Container '%s' adds dangerous capability '%s'"
NON_ROOT_MESSAGE = "%s '%s' must set runAsNonRoot=true in restricted security level"
ROOT_USER_MESSAGE = "Container '%s' cannot run as root (UID 0) in restricted security level"
DROP_ALL_MESSAGE = "Container '%s' must drop ALL capabilities in restricted security level"
READ_ONLY_MESSAGE = "Container '%s' must set readOnlyRootFilesystem=true in restricted security level"
VOLUME_MESSAGE = "Volume type '%s' is not allowed in restricted security level"
SECCOMP_MESSAGE = "Container '%s' must use RuntimeDefault or Localhost seccomp profile in restricted security level"


def containers(kind: str = "containers", scoped: bool = False) -> Column:
    """All containers of a resource, from whichever of the three places its kind keeps them.

    ``scoped`` takes the direct list of pods only, otherwise any direct list.
    """
    direct = F.col(f"spec.{kind}")
    nested = F.col(f"spec.jobTemplate.spec.template.spec.{kind}")
    if scoped:
        direct = F.when(F.col("kind") == "Pod", direct)
        nested = F.when(F.col("kind") == "CronJob", nested)
    empty = F.array().cast(T.ArrayType(CONTAINER))
    parts = [F.coalesce(p, empty) for p in (direct, F.col(f"spec.template.spec.{kind}"), nested)]
    return F.concat(*parts)


def pod_field(name: str) -> Column:
    """A field of the pod specification, found by the kind."""
    return (F.when(F.col("kind") == "Pod", F.col(f"spec.{name}"))
            .when(F.col("kind").isin(TEMPLATE_KINDS), F.col(f"spec.template.spec.{name}"))
            .when(F.col("kind") == "CronJob", F.col(f"spec.jobTemplate.spec.template.spec.{name}")))


def flatten_containers(df: DataFrame) -> DataFrame:
    """One row per container and init container of any workload kind."""
    def labelled(kind, role):
        return F.transform(containers(kind), lambda c: F.struct(F.lit(role).alias("role"), c.alias("c")))

    both = F.concat(labelled("containers", "container"), labelled("initContainers", "init"))
    return df.select("kind", "metadata.namespace", "metadata.name", F.explode(both).alias("r")).select(
        "kind", "namespace", F.col("name").alias("resource"), "r.role", "r.c.name", "r.c.image")


def scope(kinds: Sequence[str] = WORKLOAD_KINDS, excluded: Sequence[str] = SYSTEM_NAMESPACES) -> Column:
    """Whether a resource is of a matched kind and outside the excluded namespaces."""
    return F.col("kind").isin(list(kinds)) & ~F.coalesce(F.col("metadata.namespace").isin(list(excluded)), F.lit(False))


class Rule(NamedTuple):
    """A rule as columns of a resource: where it holds, and the lists of its messages, in which null is no message."""

    name: str
    action: str
    applies: Column
    messages: list[Column]


def violations(df: DataFrame, *rules: Rule) -> DataFrame:
    """All messages of the rules in one pass over the resources, equal ones of a resource once."""
    def found(rule: Rule) -> Column:
        texts = F.array_distinct(F.concat(*[F.coalesce(m, F.array().cast("array<string>")) for m in rule.messages]))
        return F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"), F.when(F.coalesce(rule.applies, F.lit(False)), texts).alias("texts"))

    told = df.select(
        "kind", F.col("metadata.namespace").alias("namespace"), F.col("metadata.name").alias("resource"),
        F.explode(F.array(*[found(r) for r in rules])).alias("r"))
    return told.select("kind", "namespace", "resource", "r.rule", "r.action", F.explode("r.texts").alias("msg")).where("msg is not null")


def latest_rule(exempt: Sequence[str] = EXEMPT_IMAGES, action: str = "deny") -> Rule:
    """``:latest`` images in any container list, unless an exempt text is part of the image name."""
    def found(place: Column, title: str) -> Column:
        def bad(c):
            spared = F.lit(False)
            for e in exempt:
                spared = spared | c["image"].contains(e)
            return c["image"].endswith(":latest") & ~spared
        before, after = LATEST_MESSAGE.replace("%s", title, 1).split("%s")
        return F.transform(place, lambda c: F.when(bad(c), F.concat(F.lit(before), c["image"], F.lit(after))))

    kind = F.col("kind")
    template = F.col("spec.template.spec.containers")
    return Rule("deny_latest", action, scope(), [
        found(template, "Container"),
        found(F.col("spec.template.spec.initContainers"), "Init container"),
        F.when(kind == "Pod", found(F.col("spec.containers"), "Pod container")),
        F.when(kind == "Pod", found(F.col("spec.initContainers"), "Pod init container")),
        F.when(kind == "Job", found(template, "Job container")),
        F.when(kind == "CronJob", found(F.col("spec.jobTemplate.spec.template.spec.containers"), "CronJob container")),
    ])


def deny_latest(df: DataFrame, *args, **options) -> DataFrame:
    """The violations of ``latest_rule``."""
    return violations(df, latest_rule(*args, **options))


def _each(place: Column, messages) -> Column:
    """All messages of the containers in one pass over the list; ``messages(c)`` gives texts or nulls."""
    return F.flatten(F.transform(place, lambda c: F.array(*messages(c))))


def limits_rule(requests: bool = True, ephemeral: bool = False, exempt: Sequence[str] = LIMIT_EXEMPT_CONTAINERS,
                action: str = "deny") -> Rule:
    """Missing resource limits, and requests unless switched off, of containers and init containers."""
    wanted = ["limits.cpu", "limits.memory"] + (["requests.cpu", "requests.memory"] if requests else [])

    def lacking(title: str, paths: Sequence[str]):
        def messages(c):
            for path in paths:
                side, item = path.split(".", 1)
                absent = F.try_element_at(c["resources"][side], F.lit(item)).isNull()
                before, after = LIMIT_MESSAGES[path].replace("%s", title, 1).split("%s")
                yield F.when(absent & ~c["name"].isin(list(exempt)), F.concat(F.lit(before), c["name"], F.lit(after)))
        return messages

    main, init = containers("containers", scoped=True), containers("initContainers", scoped=True)
    return Rule("require_limits", action, scope(), [
        _each(main, lacking("Container", wanted + (["limits.ephemeral-storage"] if ephemeral else []))),
        _each(init, lacking("Init container", wanted))])


def require_limits(df: DataFrame, *args, **options) -> DataFrame:
    """The violations of ``limits_rule``."""
    return violations(df, limits_rule(*args, **options))


def balancer_rule(allowed: Sequence[str] = PUBLIC_NAMESPACES, require_internal: bool = True, action: str = "deny") -> Rule:
    """Load balancers without an internal annotation outside the allowed namespaces."""
    def noted(name, value):
        return F.coalesce(F.try_element_at(F.col("metadata.annotations"), F.lit(name)) == value, F.lit(False))

    internal = (noted(AWS_INTERNAL, "true") | noted(GCP_INTERNAL, "Internal")
                | noted(GCP_LEGACY_INTERNAL, "Internal") | noted(AZURE_INTERNAL, "true"))
    space = F.col("metadata.namespace")
    bad = (F.lit(require_internal) & (F.col("spec.type") == "LoadBalancer") & ~internal
           & ~F.coalesce(space.isin(list(allowed)), F.lit(False)))
    return Rule("block_public_lb", action, scope(["Service"], BALANCER_NAMESPACES) & bad, [
        F.array(F.format_string(BALANCER_MESSAGE, F.col("metadata.name"), space))])


def block_public_balancer(df: DataFrame, *args, **options) -> DataFrame:
    """The violations of ``balancer_rule``."""
    return violations(df, balancer_rule(*args, **options))


def security_rule(level: str = "baseline", exempt: Sequence[str] = STANDARDS_EXEMPT_CONTAINERS, action: str = "deny") -> Rule:
    """Security level of pods: nothing for privileged, the baseline rules, and the restricted ones on top."""
    if level not in ("privileged", "baseline", "restricted"):
        raise ValueError(f"unknown security level: {level}")
    no = F.lit(False)
    base, strict = level in ("baseline", "restricted"), level == "restricted"

    def told(c, bad, message, title=None):
        if title:
            message = message.replace("%s", title, 1)
        before, after = message.split("%s")
        return F.when(bad & ~c["name"].isin(list(exempt)), F.concat(F.lit(before), c["name"], F.lit(after)))

    def unset(flag):
        return ~F.coalesce(flag, no)

    def of_main(c):
        s = c["securityContext"]
        if base:
            yield told(c, s["privileged"], PRIVILEGED_MESSAGE, "Container")
            yield told(c, s["allowPrivilegeEscalation"], ESCALATION_MESSAGE)
            for cap in DANGEROUS_CAPABILITIES:
                yield told(c, F.array_contains(s["capabilities"]["add"], cap), cap.join(CAPABILITY_MESSAGE.rsplit("%s", 1)))
        if strict:
            yield told(c, unset(s["runAsNonRoot"]), NON_ROOT_MESSAGE, "Container")
            yield told(c, s["runAsUser"] == 0, ROOT_USER_MESSAGE)
            yield told(c, unset(F.array_contains(s["capabilities"]["drop"], "ALL")), DROP_ALL_MESSAGE)
            yield told(c, unset(s["readOnlyRootFilesystem"]), READ_ONLY_MESSAGE)
            yield told(c, unset(s["seccompProfile"]["type"].isin(SECCOMP_PROFILES)), SECCOMP_MESSAGE)

    def of_init(c):
        s = c["securityContext"]
        if base:
            yield told(c, s["privileged"], PRIVILEGED_MESSAGE, "Init container")
        if strict:
            yield told(c, unset(s["runAsNonRoot"]), NON_ROOT_MESSAGE, "Init container")

    messages: list[Column] = []
    if base:
        messages.append(F.array(*[F.when(pod_field(name), HOST_MESSAGE % name) for name in ("hostNetwork", "hostPID", "hostIPC")]))
        messages += [_each(containers("containers"), of_main), _each(containers("initContainers"), of_init)]
    if strict:
        banned = F.array(*map(F.lit, RESTRICTED_VOLUMES))
        messages.append(F.flatten(F.transform(pod_field("volumes"), lambda v: F.transform(
            F.array_intersect(F.map_keys(v), banned), lambda t: F.format_string(VOLUME_MESSAGE, t)))))
    if not messages:
        messages = [F.array().cast("array<string>")]
    return Rule("pod_security", action, scope(excluded=STANDARDS_NAMESPACES), messages)


def pod_security(df: DataFrame, *args, **options) -> DataFrame:
    """The violations of ``security_rule``."""
    return violations(df, security_rule(*args, **options))


#: Bits that tell which resources may come twice; fixed, whatever the input.
TWICE_BITS = 1 << 24


def audit(df: DataFrame, level: str = "baseline") -> DataFrame:
    """Violations of every rule; equal rows, of resources that come twice, once.

    Messages are long, so only those are shuffled that may be equal. Resources are counted by the hash of kind, namespace and name first,
    and the hashes that come more than once set a bit each. A resource without its bit stands alone, and its messages are distinct as
    they are made; whatever has the bit goes through ``distinct``.
    """
    rules = latest_rule(), limits_rule(), balancer_rule(), security_rule(level)
    hashed = F.xxhash64("kind", "metadata.namespace", "metadata.name")
    bit = F.pmod(F.col("hash"), F.lit(TWICE_BITS))
    twice = df.select(hashed.alias("hash")).groupBy("hash").agg(F.count("*").alias("rows")).where("rows > 1")
    marks = cut_lineage(twice.groupBy(F.shiftright(bit, 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 as int))")).alias("_bits")))
    if marks.isEmpty():
        return violations(df, *rules)
    told = df.withColumn("_bit", F.pmod(hashed, F.lit(TWICE_BITS))).join(F.broadcast(marks), F.shiftright("_bit", 6) == F.col("_word"), "left")
    marked = F.expr("coalesce(bit_get(_bits, cast(_bit & 63 as int)), 0) = 1")
    return violations(told.where(~marked), *rules).unionByName(violations(told.where(marked), *rules).distinct())


def compliance_score(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of passed checks in percent with one decimal, and the tier."""
    names = ("total_pass", "total_fail", "total_warn", "total_info")
    row = totals.groupBy(*by).agg(*[F.sum(F.coalesce(F.col(n), F.lit(0))).cast("bigint").alias(n) for n in names])
    checks = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    score = F.round(F.coalesce(F.try_divide(F.col("total_pass").cast("double"), checks.cast("double")) * 100, F.lit(0.0)), 1)
    return row.select(*by, *names, checks.alias("total_checks"), score.alias("compliance_score")).withColumn(
        "status", F.when(F.col("compliance_score") >= 90, "COMPLIANT")
        .when(F.col("compliance_score") >= 70, "PARTIALLY COMPLIANT").otherwise("NON-COMPLIANT"))


def critical_failures(report: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` failed scored checks of nested control reports, in id order."""
    checks = report.select(F.explode("Controls").alias("g")).select(F.explode("g.checks").alias("c")).select("c.*")
    return failed_checks(checks, n)


def failed_checks(checks: DataFrame, n: int = 10) -> DataFrame:
    """Failed scored checks as report lines."""
    failed = checks.where((F.col("state") == "FAIL") & F.col("scored"))
    return failed.orderBy("id", "text").limit(n).select("id", F.format_string("- [%s] %s", "id", "text").alias("line"))
