"""Schemas, keys, defaults and clustering of the platform's tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

D38 = "decimal(38,18)"
_LINEAGE = "_ingestion_timestamp timestamp, _ingestion_date date, _source_system string, _batch_id string"


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    keys: tuple[str, ...]
    cluster_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    comment: str = ""

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    def conform(self, df: DataFrame) -> DataFrame:
        """The declared columns in order and type: absent ones get their default or NULL, extra
        ones stay at the end, and a NULL in a required column fails the job."""
        return conform(df, self)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    cols = []
    for f in spec.schema.fields:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
        else:
            c = F.lit(spec.defaults.get(f.name)).cast(f.dataType)
        if not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{spec.name}.{f.name} is NULL")).cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    declared = set(spec.schema.names)
    return df.select(*cols, *[c for c in df.columns if c not in declared])


# Table and column names of the data model.
SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in [
        TableSpec(
            "dims/dim_workspace",
            "workspace_id string not null, workspace_name string, workspace_url string, account_id string, cloud string, "
            "region string, environment string, business_unit string, department string, cost_center string, "
            "owner string, status string, created_date date, last_updated_timestamp timestamp",
            ("workspace_id",), ("workspace_id",), defaults={"status": "Active"},
        ),
        TableSpec(
            "dims/dim_date",
            "date date not null, day int, day_of_week int, day_name string, week_of_year int, month int, "
            "month_name string, quarter int, year int, fiscal_year int, fiscal_month int, is_weekend boolean, "
            "is_month_start boolean, is_month_end boolean",
            ("date",),
        ),
        TableSpec("dims/dim_environment", "environment string not null, description string", ("environment",)),
        TableSpec(
            "dims/dim_user",
            "user_id string not null, user_name string, email string, user_type string, department string, "
            "business_unit string, status string",
            ("user_id",), ("user_id",), defaults={"status": "Active"},
        ),
        TableSpec(
            "dims/dim_sku",
            "sku string not null, product string, billing_origin_product string, cloud string, usage_unit string, "
            "description string",
            ("sku",), ("sku",),
        ),
        TableSpec(
            "bronze/bronze_billing_usage",
            "account_id string, workspace_id string, record_id string, sku_name string, cloud string, "
            "usage_start_time timestamp, usage_end_time timestamp, usage_date date, custom_tags map<string,string>, "
            f"usage_unit string, usage_quantity {D38}, usage_metadata struct<cluster_id:string,job_id:string,"
            "warehouse_id:string,instance_pool_id:string,node_type:string,job_name:string,job_run_id:string,"
            "notebook_id:string,notebook_path:string,dlt_pipeline_id:string,app_name:string>, "
            "identity_metadata struct<run_as:string,created_by:string,owned_by:string,run_by:string>, "
            "record_type string, ingestion_date date, billing_origin_product string, "
            "product_features struct<is_serverless:boolean,is_photon:boolean,serving_type:string,jobs_tier:string,"
            f"sql_tier:string,dlt_tier:string>, usage_type string, {_LINEAGE}",
            ("record_id",), ("workspace_id", "usage_date"),
        ),
        TableSpec(
            "bronze/bronze_billing_prices",
            "account_id string, price_start_time timestamp, price_end_time timestamp, sku_name string, cloud string, "
            f"currency_code string, usage_unit string, pricing struct<default:{D38},promotional:struct<default:{D38}>,"
            f"effective_list:struct<default:{D38}>>, price_source string, {_LINEAGE}",
            ("sku_name", "cloud", "price_start_time"), partition_by=("_ingestion_date",),
        ),
        TableSpec(
            "bronze/bronze_audit_events",
            "account_id string, workspace_id string, version string, event_time timestamp, event_date date, "
            "source_ip_address string, user_agent string, session_id string, "
            "user_identity struct<email:string,subject_name:string>, service_name string, action_name string, "
            "request_id string, request_params map<string,string>, "
            "response struct<status_code:int,error_message:string,result:string>, audit_level string, "
            f"event_id string, identity_metadata struct<run_by:string,run_as:string>, {_LINEAGE}",
            ("event_id",), ("workspace_id", "event_date"),
        ),
        TableSpec(
            "bronze/bronze_workspace_master",
            "workspace_id string, workspace_name string, workspace_url string, account_id string, cloud string, "
            "region string, environment string, business_unit string, department string, cost_center string, "
            f"owner string, status string, created_date date, last_updated_timestamp timestamp, {_LINEAGE}",
            ("workspace_id",), partition_by=("_ingestion_date",),
        ),
        TableSpec(
            "silver/silver_billing_usage",
            "usage_date date, usage_start_time timestamp, usage_end_time timestamp, workspace_id string, "
            "workspace_name string, environment string, cloud string, region string, sku string, usage_unit string, "
            f"usage_quantity {D38}, record_type string, billing_origin_product string, job_id string, "
            "cluster_id string, warehouse_id string, instance_pool_id string, node_type string, job_name string, "
            "job_run_id string, notebook_id string, notebook_path string, dlt_pipeline_id string, app_name string, "
            "user_id string, service_principal_id string, custom_tags map<string,string>, "
            "product_features struct<is_serverless:boolean,is_photon:boolean,serving_type:string,jobs_tier:string,"
            "sql_tier:string,dlt_tier:string>, usage_type string, record_id string, ingestion_timestamp timestamp",
            ("record_id",), ("workspace_id", "sku"), partition_by=("usage_date",),
        ),
        TableSpec(
            "silver/fact_cost",
            "cost_id string not null, usage_date date, usage_start_time timestamp, usage_end_time timestamp, "
            f"workspace_id string, workspace_name string, sku string, usage_unit string, usage_quantity {D38}, "
            f"unit_price {D38}, currency string, estimated_cost {D38}, record_type string, "
            "billing_origin_product string, job_id string, cluster_id string, warehouse_id string, user_id string, "
            "service_principal_id string, cost_center string, environment string, business_unit string, "
            "region string, cloud string, ingestion_timestamp timestamp",
            ("cost_id",), ("workspace_id", "sku"), partition_by=("usage_date",),
        ),
        TableSpec(
            "silver/fact_audit_event",
            "audit_event_id string not null, event_time timestamp, event_date date, workspace_id string, "
            "workspace_name string, user_name string, user_type string, service_principal string, action_name string, "
            "service_name string, request_id string, source_ip string, user_agent string, object_type string, "
            "object_id string, object_name string, response_status int, response_error string, audit_level string, "
            "request_parameters map<string,string>, audit_details string, ingestion_timestamp timestamp",
            ("audit_event_id",), ("workspace_id", "user_name"), partition_by=("event_date",),
        ),
        TableSpec(
            "silver/fact_cost_allocation",
            "allocation_id string not null, allocation_date date, workspace_id string, workspace_name string, "
            "cost_center string, business_unit string, department string, project string, application string, "
            f"environment string, cloud string, sku string, usage_quantity {D38}, estimated_cost {D38}, job_id string, "
            "cluster_id string, warehouse_id string, user_id string, tag_source string, ingestion_timestamp timestamp",
            ("allocation_id",), ("workspace_id", "cost_center"), partition_by=("allocation_date",),
        ),
        TableSpec(
            "silver/fact_cost_anomaly",
            "anomaly_id string not null, detection_date date, workspace_id string, workspace_name string, "
            f"anomaly_type string, metric string, baseline_value {D38}, actual_value {D38}, "
            "deviation_percentage decimal(10,2), severity string, detected_timestamp timestamp, status string",
            ("anomaly_id",), ("workspace_id", "severity"), defaults={"status": "Open"},
        ),
        TableSpec(
            "gold/gold_workspace_daily_cost",
            f"usage_date date, workspace_id string, workspace_name string, environment string, total_usage {D38}, "
            f"total_cost {D38}, previous_day_cost {D38}, cost_change {D38}, cost_change_percentage decimal(10,2)",
            ("usage_date", "workspace_id"), ("workspace_id", "usage_date"),
        ),
        TableSpec(
            "gold/gold_workspace_monthly_cost",
            f"month string, workspace_id string, workspace_name string, total_usage {D38}, total_cost {D38}, "
            f"previous_month_cost {D38}, month_over_month_percentage decimal(10,2)",
            ("month", "workspace_id"), ("workspace_id", "month"),
        ),
        TableSpec(
            "gold/gold_sku_cost",
            f"usage_date date, workspace_id string, sku string, usage_quantity {D38}, estimated_cost {D38}",
            ("usage_date", "workspace_id", "sku"), ("workspace_id", "sku", "usage_date"),
        ),
        TableSpec(
            "gold/gold_user_cost",
            f"usage_date date, workspace_id string, user_name string, usage_quantity {D38}, estimated_cost {D38}",
            ("usage_date", "workspace_id", "user_name"), ("workspace_id", "user_name", "usage_date"),
        ),
        TableSpec(
            "gold/gold_job_cost",
            "usage_date date, workspace_id string, job_id string, job_name string, "
            f"usage_quantity {D38}, estimated_cost {D38}",
            ("usage_date", "workspace_id", "job_id"), ("workspace_id", "job_id", "usage_date"),
        ),
        TableSpec(
            "gold/gold_cluster_cost",
            "usage_date date, workspace_id string, cluster_id string, cluster_name string, "
            f"usage_quantity {D38}, estimated_cost {D38}",
            ("usage_date", "workspace_id", "cluster_id"), ("workspace_id", "cluster_id", "usage_date"),
        ),
        TableSpec(
            "gold/gold_audit_summary",
            "event_date date, workspace_id string, action_name string, user_name string, event_count bigint, "
            "failed_event_count bigint",
            ("event_date", "workspace_id", "action_name", "user_name"), ("workspace_id", "event_date"),
        ),
        TableSpec(
            "meta/dq_execution_log",
            "dq_run_id string not null, execution_timestamp timestamp, table_name string, check_name string, "
            "total_records bigint, failed_records bigint, status string, error_message string",
            ("dq_run_id", "table_name", "check_name"), ("execution_timestamp",),
        ),
        TableSpec(
            "meta/framework_execution_log",
            "run_id string not null, pipeline_name string, notebook_name string, start_time timestamp, "
            "end_time timestamp, duration_seconds double, records_read bigint, records_inserted bigint, "
            "records_updated bigint, records_rejected bigint, status string, error_message string",
            ("run_id",), ("start_time",),
        ),
        TableSpec(
            "meta/pipeline_watermarks",
            "pipeline_name string not null, table_name string not null, watermark_column string not null, "
            "last_watermark timestamp, last_run_date date, updated_at timestamp",
            ("pipeline_name", "table_name"), ("pipeline_name", "table_name"),
        ),
    ]
}
