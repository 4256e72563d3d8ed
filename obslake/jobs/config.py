"""Defaults of the jobs; every one can be set by an argument or an environment variable."""

from __future__ import annotations

import argparse
import os

# Topic names.
TOPICS = {
    "structured": "metrics.structured",
    "logs": "logs.raw",
    "normalized": "metrics.normalized",
    "cdc": "cdc.public.service_metadata",
    "users": "users.events",
    "external": "external.data.raw",
}

DEFAULTS = {
    "OBSLAKE_BROKERS": "localhost:9092",
    "OBSLAKE_LAKE": "metrics",
    "OBSLAKE_METADATA": "",
    "OBSLAKE_JDBC_USER": "",
    "OBSLAKE_JDBC_PASSWORD": "",
}


def env(name: str) -> str:
    return os.environ.get(name, DEFAULTS[name])


def paths(lake: str) -> dict[str, str]:
    """Folders below the lake root."""
    root = lake.rstrip("/")
    return {
        "logs_raw": f"{root}/logs/raw",
        "logs": f"{root}/logs/parquet",
        "external_raw": f"{root}/external/raw",
        "external": f"{root}/external/parquet",
        "external_rejects": f"{root}/external/rejects",
        "rejects": f"{root}/structured/rejects",
        "normalized_rejects": f"{root}/normalized/rejects",
        "cdc_rejects": f"{root}/cdc/rejects",
        "ingest_rejects": f"{root}/ingest/rejects",
        "table": f"{root}/metric_aggregates",
        "aggregated": f"{root}/aggregated",
        "rolled_up": f"{root}/metric_aggregates_rolled_up",
        "snapshot": f"{root}/service_metadata_snapshot",
        "metadata": f"{root}/service_metadata",
        "checkpoints": f"{root}/checkpoints",
    }


def parser(description: str) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=description)
    p.add_argument("--lake", default=env("OBSLAKE_LAKE"), help="root folder of all tables")
    return p


def jdbc_properties() -> dict[str, str]:
    """Credentials from the environment, never from the code."""
    pairs = {"user": env("OBSLAKE_JDBC_USER"), "password": env("OBSLAKE_JDBC_PASSWORD")}
    return {k: v for k, v in pairs.items() if v}
