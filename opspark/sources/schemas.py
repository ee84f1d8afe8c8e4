"""Explicit schemas of the inputs; production readers never infer types."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE, FLOAT, BOOL, TIME = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.FloatType(), T.BooleanType(), T.TimestampType())
STRING_MAP = T.MapType(STRING, STRING)
STRINGS = T.ArrayType(STRING)


def struct(**fields: T.DataType) -> T.StructType:
    """A struct of nullable fields."""
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


SENSOR_READING = struct(sensor_id=STRING, timestamp=LONG, value=DOUBLE)
WINDOW_FEATURES = struct(
    sensor_id=STRING, window_start=LONG, window_end=LONG, event_time=STRING,
    features=struct(avg_value=DOUBLE, min_value=DOUBLE, max_value=DOUBLE, std_dev=DOUBLE, count=LONG,
                    anomaly_count=LONG, anomaly_rate=DOUBLE))
PREDICTION_LOG = struct(ts=DOUBLE, feature=DOUBLE, pred=DOUBLE, actual=DOUBLE)
DRIVER_STATS = struct(driver_id=LONG, conv_rate=FLOAT, acc_rate=FLOAT, avg_daily_trips=LONG, event_timestamp=TIME)
SENSOR_FEATURES = struct(sensor_id=STRING, event_timestamp=TIME, avg_value=FLOAT)
METRIC_SAMPLE = struct(metric=STRING, labels=STRING_MAP, ts=TIME, value=DOUBLE)
REQUEST_LOG = struct(ts=TIME, service=STRING, version=STRING, status=STRING, latency_ms=DOUBLE)
COST_SHEET = struct(Scenario=STRING, MonthlyHours=INT, GPUType=STRING, CostPerHourUSD=DOUBLE, MonthlyCostUSD=DOUBLE,
                    _corrupt=STRING)
EVIDENCE = struct(timestamp=STRING, commit=STRING, run_id=STRING, terraform_hash=STRING, image_digest=STRING,
                  evidence_version=STRING, signing_algorithm=STRING)
COMPLIANCE_REPORT = struct(
    Totals=struct(total_pass=LONG, total_fail=LONG, total_warn=LONG, total_info=LONG),
    Controls=T.ArrayType(struct(checks=T.ArrayType(struct(id=STRING, text=STRING, state=STRING, scored=BOOL)))))
SPAN = struct(trace_id=STRING, span_id=STRING, parent_id=STRING, name=STRING, start=TIME, end=TIME, attrs=STRING_MAP)
LINEAGE_EVENT = struct(run_id=STRING, task=STRING, dataset=STRING, kind=STRING, ts=TIME)

CONTAINER = struct(
    name=STRING, image=STRING, resources=struct(limits=STRING_MAP, requests=STRING_MAP),
    securityContext=struct(
        privileged=BOOL, allowPrivilegeEscalation=BOOL, runAsNonRoot=BOOL, readOnlyRootFilesystem=BOOL, runAsUser=LONG,
        capabilities=struct(add=STRINGS, drop=STRINGS), seccompProfile=struct(type=STRING)))
POD_FIELDS = dict(
    hostNetwork=BOOL, hostPID=BOOL, hostIPC=BOOL, volumes=T.ArrayType(STRING_MAP),
    containers=T.ArrayType(CONTAINER), initContainers=T.ArrayType(CONTAINER))
POD = struct(**POD_FIELDS)
RESOURCE = struct(
    kind=STRING, metadata=struct(name=STRING, namespace=STRING, annotations=STRING_MAP),
    spec=struct(type=STRING, **POD_FIELDS, template=struct(spec=POD),
                jobTemplate=struct(spec=struct(template=struct(spec=POD)))))
