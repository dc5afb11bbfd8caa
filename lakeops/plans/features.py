"""Feature tables: tables with primary keys (and optional timestamp keys)
that training sets look up exactly or as of a time.

Keys live in the table properties.  Every write validates the keys with one
distributed aggregation (duplicates or NULL keys fail the write); a
``merge`` write upserts by key into a new table version.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from lakeops.operators.asof import FeatureLookup
from lakeops.operators.asof import create_training_set as _training_set
from lakeops.operators.changes import merge_upsert
from lakeops.operators.quality import primary_key_violations
from lakeops.plans.tables import TableStore


@dataclass
class FeatureTableInfo:
    name: str
    primary_keys: list[str]
    timestamp_keys: list[str]
    description: str | None
    features: list[str]


class KeyViolation(ValueError):
    pass


class FeatureStore:
    def __init__(self, store: TableStore):
        self.store = store
        self.spark = store.spark

    def _check_keys(self, df: DataFrame, keys: list[str]) -> None:
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise KeyViolation(f"key columns missing: {missing}")
        bad = primary_key_violations(df, keys).limit(1).collect()
        if bad:
            raise KeyViolation(f"keys {keys} are not unique and non-NULL, e.g. {bad[0].asDict()}")

    def create_table(self, name: str, primary_keys: list[str] | str, df: DataFrame | None = None,
                     schema: StructType | None = None, timestamp_keys: list[str] | str | None = None,
                     description: str | None = None) -> FeatureTableInfo:
        pks = [primary_keys] if isinstance(primary_keys, str) else list(primary_keys)
        tks = [timestamp_keys] if isinstance(timestamp_keys, str) else list(timestamp_keys or [])
        if df is None:
            if schema is None:
                raise ValueError("give df or schema")
            df = self.spark.createDataFrame([], schema)
        self._check_keys(df, pks + tks)
        props = {"primary_keys": json.dumps(pks), "timestamp_keys": json.dumps(tks)}
        if description:
            props["description"] = description
        self.store.write(df, name, properties=props, operation="CREATE FEATURE TABLE")
        return self.get_table(name)

    def write_table(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        info = self.get_table(name)
        keys = info.primary_keys + info.timestamp_keys
        if mode == "merge":
            df = merge_upsert(self.read_table(name), df.select(*self.read_table(name).columns), keys)
        elif mode != "overwrite":
            raise ValueError("mode must be overwrite or merge")
        self._check_keys(df, keys)
        props = {"primary_keys": json.dumps(info.primary_keys),
                 "timestamp_keys": json.dumps(info.timestamp_keys)}
        if info.description:
            props["description"] = info.description
        self.store.write(df, name, properties=props, operation=f"WRITE FEATURES ({mode})")

    def get_table(self, name: str) -> FeatureTableInfo:
        props = self.store.properties(name)
        pks = json.loads(props.get("primary_keys", "[]"))
        tks = json.loads(props.get("timestamp_keys", "[]"))
        cols = self.store.read(name).columns
        return FeatureTableInfo(self.store.full_name(name), pks, tks, props.get("description"),
                                [c for c in cols if c not in pks + tks])

    def read_table(self, name: str) -> DataFrame:
        return self.store.read(name)

    def drop_table(self, name: str) -> None:
        self.store.drop(name)

    def lookup(self, name: str, lookup_key: list[str] | str, timestamp_lookup_key: str | None = None,
               feature_names: list[str] | None = None) -> FeatureLookup:
        info = self.get_table(name)
        keys = [lookup_key] if isinstance(lookup_key, str) else list(lookup_key)
        if len(keys) != len(info.primary_keys):
            raise ValueError(f"{name} has the keys {info.primary_keys}; looked up by {keys}")
        if info.timestamp_keys and not timestamp_lookup_key:
            raise ValueError(f"{name} has the time key {info.timestamp_keys}: give timestamp_lookup_key")
        return FeatureLookup(self.read_table(name), keys,
                             timestamp_lookup_key=timestamp_lookup_key if info.timestamp_keys else None,
                             feature_names=feature_names, table_keys=info.primary_keys,
                             table_timestamp_key=(info.timestamp_keys or ["ts"])[0])

    def create_training_set(self, df: DataFrame, lookups: list[FeatureLookup],
                            exclude_columns: list[str] | None = None,
                            label: str | None = None) -> DataFrame:
        return _training_set(df, lookups, exclude_columns, label)
