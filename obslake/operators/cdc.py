"""Change feed of the service metadata: folding it, and applying it to metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from obslake.functions.text import is_blank
from obslake.operators.dimension import (
    ROWS_PER_TASK, hot_keys, left_join_dimension, per_row, repeated_for_salts, with_salt,
)
from obslake.schemas import METADATA


def _is_delete(op: Column) -> Column:
    return F.coalesce(F.lower(op) == "d", F.lit(False))


def fold_cdc(changes: DataFrame, order_by: list[str]) -> DataFrame:
    """Latest state per service: the last change wins as a whole row, a delete removes it.

    Changes without a service id are skipped.  The maximum is taken per task
    before the shuffle, so a service with very many changes sends one row per task.
    """
    last = F.max_by(F.struct("op", *METADATA), F.struct(*order_by)).alias("_last")
    return (
        changes.filter(~is_blank(F.col("service_id")))
        .groupBy("service_id")
        .agg(last)
        .filter(~_is_delete(F.col("_last.op")))
        .select("service_id", *[F.col(f"_last.{c}").alias(c) for c in METADATA])
    )


def cdc_enrich(metrics: DataFrame, snapshot: DataFrame, spread_by: list[str] | None = None, **join) -> DataFrame:
    """Overwrite metadata columns with the non-null values of the folded change feed.

    Works on metrics and on window aggregates; columns that ``metrics`` does not
    have are not added.
    """
    targets = [c for c in METADATA if c in metrics.columns]
    dimension = snapshot.select("service_id", *[F.col(c).alias(f"_c_{c}") for c in targets])
    if spread_by is None:
        spread_by = per_row(metrics.drop("service_id"))
    joined = left_join_dimension(metrics, dimension, "service_id", spread_by, **join)
    return joined.select(
        *[
            F.coalesce(f"_c_{c}", c).alias(c) if c in targets else F.col(c)
            for c in metrics.columns
        ]
    )


def cdc_enrich_in_order(
    metrics: DataFrame,
    changes: DataFrame,
    arrival: str,
    change_order: list[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Apply to each metric the state its service had when the metric arrived.

    ``changes`` has the same ``arrival`` column; a change and a metric arriving
    together count as change first.  Earlier state is passed in as changes with a
    null ``arrival``.  Rows run through one running window per (service, salt): the
    metrics of a hot service are spread over several salts, its far fewer changes
    go to all of them, and the running frame keeps only the last change.
    """
    targets = [c for c in METADATA if c in metrics.columns]
    spread_by = per_row(metrics.drop("service_id"))
    hot = hot_keys(metrics, "service_id", rows_per_task)
    rows = with_salt(metrics, "service_id", hot, spread_by).select(
        "*",
        F.lit(1).alias("_kind"),
        F.lit(None).cast(_change_type(changes, targets)).alias("_change"),
        *[F.lit(None).cast(changes.schema[c].dataType).alias(f"_o_{c}") for c in change_order],
    )
    valid = changes.filter(~is_blank(F.col("service_id")))
    feed = repeated_for_salts(valid, "service_id", hot).select(
        "service_id",
        F.col(arrival),
        "_salt",
        F.lit(0).alias("_kind"),
        F.struct(_is_delete(F.col("op")).alias("gone"), *targets).alias("_change"),
        *[F.col(c).alias(f"_o_{c}") for c in change_order],
    )
    running = (
        Window.partitionBy("service_id", "_salt")
        .orderBy(arrival, "_kind", *[f"_o_{c}" for c in change_order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    current = F.last("_change", ignorenulls=True).over(running)
    merged = rows.unionByName(feed, allowMissingColumns=True).withColumn("_current", current)
    state = F.when(~F.col("_current.gone"), F.col("_current"))
    return merged.filter("_kind = 1").select(
        *[
            F.coalesce(state[c], F.col(c)).alias(c) if c in targets else F.col(c)
            for c in metrics.columns
        ]
    )


def _change_type(changes: DataFrame, targets: list[str]) -> str:
    fields = ["gone: boolean"] + [f"{c}: {changes.schema[c].dataType.simpleString()}" for c in targets]
    return f"struct<{', '.join(fields)}>"
