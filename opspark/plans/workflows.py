"""End-to-end flows: prepare a table, engineer features, evaluate, monitor."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from opspark.functions.columns import numeric_columns
from opspark.operators import drift, features as fe, prepare as pr, profile
from opspark.session import small_rows
from opspark.sources import stored

# The default settings of the flows.
DEFAULTS = {
    "prepare": {
        "test_split": 0.2, "validation_split": 0.1, "seed": 42, "normalize": True,
        "handle_missing": "median", "outlier_method": "iqr", "outlier_threshold": 1.5,
    },
    "engineering": {
        "polynomial_degree": 2, "interaction_only": False, "create_clusters": True, "n_clusters": 5,
        "encode_categorical": True, "encoding_method": "target",
    },
    "selection": {"method": "mutual_info", "k_best": 20, "variance_threshold": 0.01},
    "drift": {"method": "ks", "threshold": 0.1},
}


@dataclass
class Prepared:
    """A prepared table with its split column and everything fitted on the way."""

    table: DataFrame
    state: dict = field(default_factory=dict)
    applied: list[str] = field(default_factory=list)

    def part(self, name: str) -> DataFrame:
        return self.table.where(F.col("split") == name).drop("split")


def prepare_table(df: DataFrame, key: str, label: str | None = None, config: dict | None = None,
                  fit_on: str = "all") -> Prepared:
    """Missing values, outliers, scaling, split; the key is never changed.

    Statistics come from all rows by default; ``fit_on="train"`` splits first
    and fits on the training part only.
    """
    cfg = {**DEFAULTS["prepare"], **(config or {})}
    state, applied = {}, []
    keep = [c for c in (key, label) if c]

    def tag(d):
        return pr.split(d, key, label, cfg["test_split"], cfg["validation_split"], cfg["seed"])

    work = tag(df) if fit_on == "train" else df

    def basis(d):
        return d.where("split = 'train'") if fit_on == "train" else d

    method = cfg["handle_missing"]
    skip = [*keep, "split"]
    if method == "drop":
        work = pr.drop_missing(work)
    elif method == "knn":
        work = pr.knn_impute(work, key, numeric_columns(work, skip))
        state["imputer"] = pr.modes(basis(work), [c for c in fe.string_columns(work, skip)])
        work = pr.apply_imputer(work, state["imputer"])
    else:
        state["imputer"] = {c: v for c, v in pr.fit_imputer(basis(work), method).items() if c not in skip}
        work = pr.apply_imputer(work, state["imputer"])
    applied.append(f"missing_values: {method}")
    cols = numeric_columns(work, skip)
    state["outliers"] = pr.fit_outliers(basis(work), cfg["outlier_method"], cfg["outlier_threshold"], cols=cols)
    work = pr.apply_outliers(work, state["outliers"])
    applied.append(f"outliers: {cfg['outlier_method']}")
    if cfg["normalize"]:
        state["scaler"] = pr.fit_scaler(basis(work), robust=cfg["outlier_method"] == "none", cols=cols)
        work = pr.apply_scaler(work, state["scaler"])
        applied.append("normalized_features")
    if fit_on != "train":
        work = tag(work)
    return Prepared(work, state, applied)


def apply_prepared(df: DataFrame, state: dict) -> DataFrame:
    """Fill, filter and scale other rows by fitted (or reloaded) state, in the order of the fit."""
    if "imputer" in state:
        df = pr.apply_imputer(df, state["imputer"])
    df = pr.apply_outliers(df, state["outliers"])
    return pr.apply_scaler(df, state["scaler"]) if "scaler" in state else df


def _family(kind: str) -> str:
    return "number" if kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")) else kind


@dataclass
class FeatureFlow:
    """Fitted feature engineering, applied in the same order to any part; it can be saved and loaded."""

    degree: int
    interaction_only: bool
    base: list[str]
    cluster_columns: list[str]
    centres: list | None
    encoders: dict | None
    selected: list[str]
    label: str
    columns: dict[str, str] = field(default_factory=dict)  # what the flow was fitted on: name and type

    def check(self, df: DataFrame) -> None:
        """An error that names the columns which are missing or of another type family than those of the fit."""
        have = dict(df.dtypes)
        wrong = [f"{c} is missing" for c in self.columns if c not in have]
        wrong += [f"{c} is {have[c]}, not {kind}" for c, kind in self.columns.items() if c in have and _family(have[c]) != _family(kind)]
        if wrong:
            raise ValueError("; ".join(wrong))

    def engineer(self, df: DataFrame) -> DataFrame:
        df = fe.polynomial_features(df, self.degree, self.interaction_only, self.label, self.base)
        if self.centres:
            df = fe.cluster_features(df, self.cluster_columns, self.centres)
        if self.encoders:
            df = fe.apply_encoders(df, self.encoders)
        return df

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The selected features and the label; columns to ``keep``, like keys, ride along in front."""
        self.check(df)
        return fe.project(self.engineer(df), [*keep, *self.selected], self.label)

    def save(self, spark, folder: str, at: datetime | None = None, state: dict | None = None) -> str:
        """A new version under ``folder``; ``state`` is the preparation's state, kept with it. Returns the version's path."""
        document = {
            "degree": self.degree, "interaction_only": self.interaction_only, "base": self.base, "label": self.label, "columns": self.columns,
            "cluster_columns": self.cluster_columns, "clusters": len(self.centres or []), "state": state, "encoders": None}
        tables = {"selection": spark.createDataFrame(list(enumerate(self.selected)), "place int, feature string")}
        if self.centres:
            tables["centres"] = spark.createDataFrame(
                [(i, j, float(v)) for i, c in enumerate(self.centres) for j, v in enumerate(c)], "cluster int, place int, value double")
        if self.encoders:
            document["encoders"] = {"method": self.encoders["method"], "columns": []}
            for i, (c, table) in enumerate(self.encoders["columns"].items()):
                size = table[1] if isinstance(table, tuple) else None
                document["encoders"]["columns"].append({"column": c, "wide": isinstance(table, list), "size": size})
                if isinstance(table, list):
                    table = spark.createDataFrame([(v, n) for n, v in enumerate(table)], "category string, code int")
                tables[f"encoder_{i}"] = table[0] if isinstance(table, tuple) else table
        path = stored.new_version(folder, at)
        stored.save_parts(spark, path, document, tables)
        return path


def load_flow(spark, path: str) -> tuple[FeatureFlow, dict | None]:
    """A saved flow, and the preparation state kept with it. Encoder tables stay tables; selection and centres are per column."""
    d, tables = stored.load_parts(spark, path)
    selected = [r["feature"] for r in small_rows(tables["selection"].orderBy("place"))]
    centres = None
    if d["clusters"]:
        centres = [[0.0] * len(d["cluster_columns"]) for _ in range(d["clusters"])]
        for r in small_rows(tables["centres"]):
            centres[r["cluster"]][r["place"]] = r["value"]
    encoders = None
    if d["encoders"]:
        encoders = {"method": d["encoders"]["method"], "columns": {}}
        for i, c in enumerate(d["encoders"]["columns"]):
            table = tables[f"encoder_{i}"]
            if c["wide"]:
                table = [r["category"] for r in small_rows(table.orderBy("code"))]
            encoders["columns"][c["column"]] = (table, c["size"]) if c["size"] else table
    flow = FeatureFlow(d["degree"], d["interaction_only"], d["base"], d["cluster_columns"], centres, encoders, selected, d["label"], d["columns"])
    return flow, d["state"]


def load_latest_flow(spark, folder: str) -> tuple[FeatureFlow, dict | None]:
    """The newest complete version."""
    return load_flow(spark, stored.latest_version(spark, folder))


def fit_features(train: DataFrame, label: str = "target", engineering: dict | None = None,
                 selection: dict | None = None) -> FeatureFlow:
    """Fit polynomials, clusters, encodings and selection on the training part."""
    eng = {**DEFAULTS["engineering"], **(engineering or {})}
    sel = {**DEFAULTS["selection"], **(selection or {})}
    base = numeric_columns(train, [label])
    columns = {c: kind for c, kind in train.dtypes if c != label}
    flow = FeatureFlow(eng["polynomial_degree"], eng["interaction_only"], base, [], None, None, [], label, columns)
    work = fe.polynomial_features(train, flow.degree, flow.interaction_only, label, base)
    if eng["create_clusters"]:
        flow.cluster_columns = numeric_columns(work, [label])
        flow.centres = fe.fit_clusters(work, flow.cluster_columns, eng["n_clusters"])
        if flow.centres:
            work = fe.cluster_features(work, flow.cluster_columns, flow.centres)
    if eng["encode_categorical"]:
        flow.encoders = fe.fit_encoders(work, eng["encoding_method"], label)
        work = fe.apply_encoders(work, flow.encoders)
    flow.selected = fe.fit_selection(work, sel["method"], sel["k_best"], sel["variance_threshold"], label)
    return flow


def monitor(reference: DataFrame, current: DataFrame, config: dict | None = None, label: str = "target") -> dict[str, DataFrame]:
    """Drift scores and verdict with the data quality of the current batch."""
    cfg = {**DEFAULTS["drift"], **(config or {})}
    cols = numeric_columns(reference, [label])
    scores = drift.drift_scores(reference, current, cols, cfg["method"], label)
    return {
        "drift_scores": scores,
        "drift_verdict": drift.drift_verdict(scores, len(cols), cfg["threshold"]),
        "quality_issues": profile.quality_issues(current),
        "quality_score": profile.quality_score(current),
    }
