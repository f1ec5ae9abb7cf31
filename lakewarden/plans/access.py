"""Access events, warehouse changes and compute inventory."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from lakewarden.functions import ago, bucket, json_field, since
from lakewarden.operators.latest import latest
from lakewarden.operators.ranking import scd_history
from lakewarden.operators.shape import first_rows
from lakewarden.session import durable

# Audit actions that create, edit and delete a warehouse.
CREATES = ["createWarehouse", "createEndpoint"]
EDITS = ["editWarehouse", "editEndpoint"]
DELETES = ["deleteWarehouse", "deleteEndpoint"]
# Idle limits in minutes above which compute is a cost risk.
CLUSTER_RISK = [(60, "HIGH"), (30, "MEDIUM")]
WAREHOUSE_RISK = [(30, "HIGH"), (10, "MEDIUM")]


def workspaces_dim(workspaces: DataFrame) -> DataFrame:
    label = F.concat(F.coalesce("workspace_name", F.lit("")), F.lit(" (id: "), "workspace_id",
                     F.lit(")"))
    return workspaces.select("account_id", "workspace_id", "workspace_name", "workspace_url",
                             "status", label.alias("workspace_full_name"))


def warehouses_dim(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(
        "*", F.concat("warehouse_name", F.lit(" (id:"), "warehouse_id", F.lit(")"))
        .alias("warehouse_full_name"),
        F.when(F.col("delete_time").isNotNull(), "Deleted").otherwise("Active").alias("is_deleted"))


def refine_usage(usage: DataFrame) -> DataFrame:
    """Usage records of warehouses, with the warehouse and the day as columns."""
    return usage.filter("usage_metadata.warehouse_id IS NOT NULL").select(
        F.col("usage_metadata.warehouse_id").alias("warehouse_id"), "*",
        F.to_date("usage_start_time").alias("usage_start_date"))


def refine_scaling(warehouse_events: DataFrame) -> DataFrame:
    return warehouse_events.select("*", F.to_date("event_time").alias("event_date"))


def refine_warehouse_events(audit: DataFrame, service: str) -> DataFrame:
    """Successful warehouse changes; a create event carries the id in its result."""
    params = F.col("request_params")
    actions = [*CREATES, *EDITS, *DELETES]
    status = F.expr("try_cast(response['status_code'] AS INT)")
    warehouse_id = F.when(F.col("action_name").isin(CREATES),
                          json_field(F.col("response")["result"], "id")).otherwise(params["id"])
    return audit.filter(
        (F.col("service_name") == service) & F.col("action_name").isin(actions) & (status == 200)
    ).select(
        "event_id", "event_time", F.to_date("event_time").alias("event_date"), "workspace_id",
        "account_id", "action_name", F.col("user_identity.email").alias("warehouse_editor_user"),
        warehouse_id.alias("warehouse_id"), params["name"].alias("warehouse_name"),
        params["warehouse_type"].alias("warehouse_type"),
        params["auto_stop_mins"].alias("auto_stop_mins"),
        params["cluster_size"].alias("warehouse_size"),
        F.expr("try_cast(request_params['min_num_clusters'] AS INT)").alias("min_cluster_scaling"),
        F.expr("try_cast(request_params['max_num_clusters'] AS INT)").alias("max_cluster_scaling"),
        json_field(params["channel"], "name").alias("warehouse_channel"))


def warehouse_scd(changes: DataFrame) -> DataFrame:
    """Change history per warehouse: the latest create event and all edits and deletes.

    The changes are a small part of the audit log and are needed several times, so they are
    written out once instead of scanning the log again.
    """
    action = F.col("action_name")
    changes = durable(changes, "changes")
    created = latest(changes.filter(action.isin(CREATES)), ["warehouse_id"],
                     ["event_time", "event_id"])
    history = created.unionByName(changes.filter(action.isin([*EDITS, *DELETES])))
    return scd_history(history, ["account_id", "workspace_id", "warehouse_id"],
                       ["event_time", "event_id"], action.isin(DELETES))


def denied_access(audit: DataFrame, as_of: datetime, days: int = 7,
                  n: int | None = None) -> DataFrame:
    edge = F.lit(ago(as_of, days, "days").date())
    status = F.expr("try_cast(response['status_code'] AS INT)")
    report = audit.filter((F.col("event_date") >= edge) & (status != 200)).select(
        "event_time", F.col("user_identity.email").alias("user_email"), "source_ip_address",
        "action_name", F.col("request_params")["full_name_arg"].alias("resource"),
        F.col("response")["error_message"].alias("error_message"))
    return first_rows(report, [F.desc("event_time"), F.col("user_email")], n)


def denied_by_catalog(audit: DataFrame, as_of: datetime, days: int = 3) -> DataFrame:
    denied = denied_access(audit, as_of, days, n=None)
    return denied.groupBy(F.split_part("resource", F.lit("."), F.lit(1)).alias("catalog_name")
                          ).agg(F.count("*").alias("denied"))


def cluster_inventory(clusters: DataFrame, as_of: datetime, days: int = 30,
                      n: int | None = None) -> DataFrame:
    report = since(clusters, "change_time", as_of, days).filter("delete_time IS NULL").select(
        "cluster_id", "cluster_name", "owned_by", "cluster_source", "runtime_version",
        "worker_node_type", "driver_node_type", "change_time")
    return first_rows(report, [F.desc("change_time"), F.col("cluster_id")], n)


def tag_check(clusters: DataFrame, name_part: str, required: str) -> DataFrame:
    """Existing clusters by name and whether they carry the required tag."""
    return clusters.filter(
        F.lower("cluster_name").contains(name_part.lower()) & F.col("delete_time").isNull()
    ).select("cluster_name", F.try_element_at("tags", F.lit(required)).alias("tag_value"),
             F.map_contains_key("tags", required).alias("has_tag"), "change_time"
             ).orderBy(F.desc("change_time"), "cluster_name")


def cost_risk(clusters: DataFrame, warehouses: DataFrame, as_of: datetime,
              days: int = 7) -> DataFrame:
    """Clusters and warehouses in one list, labelled by idle time."""
    c = since(clusters, "change_time", as_of, days).filter("delete_time IS NULL").select(
        F.lit("Cluster").alias("type"), F.col("cluster_name").alias("name"),
        F.col("owned_by").alias("owner"), F.col("driver_node_type").alias("size"),
        F.col("auto_termination_minutes").alias("auto_stop_mins"),
        bucket(F.col("auto_termination_minutes"), CLUSTER_RISK, "OK").alias("cost_risk"))
    w = warehouses.filter("delete_time IS NULL").select(
        F.lit("Warehouse").alias("type"), F.col("warehouse_name").alias("name"),
        F.lit("").alias("owner"), F.col("warehouse_size").alias("size"),
        F.col("auto_stop_minutes").alias("auto_stop_mins"),
        bucket(F.col("auto_stop_minutes"), WAREHOUSE_RISK, "OK").alias("cost_risk"))
    return c.unionByName(w).orderBy(F.desc("cost_risk"), "type")


def maintenance_log(ops: DataFrame, catalog: str, n: int | None = None) -> DataFrame:
    report = ops.filter(F.col("catalog_name") == catalog).select(
        "table_name", "operation_type", "operation_status", "files_rewritten", "start_time",
        "end_time")
    return first_rows(report, [F.desc("start_time"), F.col("table_name")], n)
