"""The schema contract: declared type, missing policy, leakage mark, categories, range."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import yaml
from pyspark.sql import types as T

# Declared type names and the Spark types they read as.
SPARK_TYPES = {
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "categorical": T.StringType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "datetime": T.TimestampNTZType(),
}

# Missing policies.
POLICIES = ("forbidden", "allow", "impute_median", "impute_mode", "impute_zero")


@dataclass(frozen=True)
class Contract:
    features: dict[str, dict]
    target: dict[str, dict]
    constraints: dict = field(default_factory=dict)
    feature_engineering: dict = field(default_factory=dict)

    @classmethod
    def from_dict(cls, d: dict) -> Contract:
        return cls(
            dict(d.get("features") or {}),
            dict(d.get("target") or {}),
            dict(d.get("constraints") or {}),
            dict(d.get("feature_engineering") or {}),
        )

    @classmethod
    def load(cls, path: str, spark=None) -> Contract:
        """Read a YAML contract; with a session also from any storage Spark reads."""
        if os.path.isfile(path):
            with open(path) as f:
                return cls.from_dict(yaml.safe_load(f) or {})
        if spark is not None:
            from pyspark.errors import AnalysisException

            try:
                return cls.from_dict(yaml.safe_load(spark.read.text(path, wholetext=True).first()[0]))
            except AnalysisException:
                pass
        raise FileNotFoundError(f"Schema file not found: {path}")

    def save(self, path: str, spark) -> None:
        """Write the contract as YAML to any storage Spark writes; :meth:`load` reads it back."""
        text = yaml.safe_dump(self.info(), sort_keys=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @property
    def columns(self) -> dict[str, dict]:
        """Features in declared order, then the target."""
        return {**self.features, **self.target}

    def info(self) -> dict:
        return {
            "features": self.features,
            "target": self.target,
            "constraints": self.constraints,
            "feature_engineering": self.feature_engineering,
        }

    def leaky(self) -> list[str]:
        return [c for c, s in self.features.items() if s.get("leaky", False)]

    def training(self) -> list[str]:
        return [c for c, s in self.features.items() if not s.get("leaky", False)]

    @property
    def target_name(self) -> str:
        return next(iter(self.target))

    def policy(self, column: str) -> str:
        return self.columns[column].get("missing_policy", "forbidden")

    def schema(self) -> T.StructType:
        """Spark schema with the rest of the contract as field metadata."""
        fields = []
        for name, spec in self.columns.items():
            kept = {k: spec[k] for k in ("type", "missing_policy", "leaky", "categories", "range") if k in spec}
            fields.append(T.StructField(name, SPARK_TYPES.get(spec.get("type"), T.StringType()), True, kept))
        return T.StructType(fields)
