"""Table specs, control-table schemas and the five business specs.

A ``TableSpec`` is data: key columns, business columns in ordinal order
with their types, and the order that picks the latest row of a key.  One
merge function serves every table; there is no code per table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Metadata column names.  Fixed values: these names must equal the
# reference's for the RAW and STAGING layouts to line up.
# RAW audit columns stamped on load, in this order:
#   _pipeline_name, _batch_id, _run_id, _load_type, _source_file
# RAW columns read by the merge:
#   _is_deleted, _ingestion_timestamp
# STAGING metadata columns, in this order:
#   _cdc_operation, _cdc_timestamp, _is_deleted, _is_current,
#   _pipeline_name, _batch_id, _run_id, _created_at, _updated_at
# ---------------------------------------------------------------------------
AUDIT_COLUMNS = ("_pipeline_name", "_batch_id", "_run_id", "_load_type", "_source_file")
RAW_EXTRA_COLUMNS = ("_is_deleted", "_ingestion_timestamp")
STAGING_META_COLUMNS = ("_cdc_operation", "_cdc_timestamp", "_is_deleted", "_is_current",
                        "_pipeline_name", "_batch_id", "_run_id", "_created_at", "_updated_at")

STAGING_META_TYPES = {
    "_cdc_operation": T.StringType(), "_cdc_timestamp": T.TimestampNTZType(),
    "_is_deleted": T.BooleanType(), "_is_current": T.BooleanType(),
    "_pipeline_name": T.StringType(), "_batch_id": T.StringType(), "_run_id": T.StringType(),
    "_created_at": T.TimestampNTZType(), "_updated_at": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class TableSpec:
    """Describes one business table for load and merge.

    ``columns`` lists every business column in ordinal order (keys first,
    ``created_at``/``updated_at`` last) with its Spark type.
    """

    name: str
    keys: tuple[str, ...]
    columns: tuple[tuple[str, T.DataType], ...]
    updated_column: str = "updated_at"
    created_column: str = "created_at"
    order_columns: tuple[str, ...] = ("updated_at", "_ingestion_timestamp")
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def update_columns(self) -> list[str]:
        """Columns an UPDATE overwrites: all but the keys and created_at."""
        return [c for c in self.column_names
                if c not in self.keys and c != self.created_column]

    def business_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.columns])

    def raw_schema(self) -> T.StructType:
        s = self.business_schema()
        for c in AUDIT_COLUMNS:
            s = s.add(c, T.StringType(), True)
        s = s.add("_is_deleted", T.BooleanType(), True)
        s = s.add("_ingestion_timestamp", T.TimestampNTZType(), True)
        return s

    def staging_schema(self) -> T.StructType:
        s = self.business_schema()
        for c in STAGING_META_COLUMNS:
            s = s.add(c, STAGING_META_TYPES[c], True)
        return s


_SIMPLE_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
                 "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
                 "timestamp_ntz": T.TimestampNTZType(), "timestamp": T.TimestampType()}


def parse_type(text: str) -> T.DataType:
    """The few flat types control and business tables use (no session needed)."""
    t = text.strip().lower()
    if t.startswith("decimal"):
        p, s = t[t.index("(") + 1:t.index(")")].split(",")
        return T.DecimalType(int(p), int(s))
    return _SIMPLE_TYPES[t]


def _split_top(text: str) -> list[str]:
    parts, depth, cur = [], 0, ""
    for ch in text:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            parts.append(cur)
            cur = ""
        else:
            cur += ch
    parts.append(cur)
    return [p.strip() for p in parts if p.strip()]


def _cols(text: str) -> tuple[tuple[str, T.DataType], ...]:
    """Parse ``name type, name type`` into (name, Spark type) pairs."""
    out = []
    for part in _split_top(text):
        name, typ = part.split(None, 1)
        out.append((name, parse_type(typ)))
    return tuple(out)


def schema_of(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in _cols(text)])


# ---------------------------------------------------------------------------
# The five business tables of the reference, their key and
# their business columns in ordinal order.  Types are inferred (the
# reference has no DDL for RAW or STAGING).
# ---------------------------------------------------------------------------
SUPPLIERS = TableSpec("SUPPLIERS", ("supplier_id",), _cols(
    "supplier_id bigint, supplier_name string, supplier_code string, country string, "
    "city string, contact_email string, contact_phone string, payment_terms string, "
    "supplier_status string, rating decimal(3,2), created_at timestamp_ntz, "
    "updated_at timestamp_ntz"))

PURCHASE_ORDERS = TableSpec("PURCHASE_ORDERS", ("po_id",), _cols(
    "po_id bigint, po_number string, supplier_id bigint, order_date date, "
    "expected_date date, actual_date date, po_status string, total_amount decimal(18,2), "
    "currency string, line_items_count int, warehouse_id bigint, notes string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"))

INVENTORY = TableSpec("INVENTORY", ("inventory_id",), _cols(
    "inventory_id bigint, product_id bigint, product_name string, product_sku string, "
    "warehouse_id bigint, warehouse_name string, quantity_on_hand int, "
    "quantity_reserved int, quantity_available int, unit_cost decimal(18,2), "
    "reorder_point int, reorder_quantity int, last_count_date date, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"))

SHIPMENTS = TableSpec("SHIPMENTS", ("shipment_id",), _cols(
    "shipment_id bigint, shipment_number string, po_id bigint, carrier_name string, "
    "tracking_number string, origin_country string, dest_country string, ship_date date, "
    "expected_date date, actual_date date, shipment_status string, weight_kg decimal(18,3), "
    "total_pieces int, freight_cost decimal(18,2), created_at timestamp_ntz, "
    "updated_at timestamp_ntz"))

SALES_ORDERS = TableSpec("SALES_ORDERS", ("order_id",), _cols(
    "order_id bigint, order_number string, customer_id bigint, customer_name string, "
    "order_date date, ship_date date, delivery_date date, order_status string, "
    "order_amount decimal(18,2), discount_amount decimal(18,2), tax_amount decimal(18,2), "
    "total_amount decimal(18,2), currency string, sales_channel string, region string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"))

BUSINESS_SPECS = {s.name: s for s in (SUPPLIERS, PURCHASE_ORDERS, INVENTORY, SHIPMENTS,
                                      SALES_ORDERS)}


class UnknownTableError(KeyError):
    """No spec is registered for a configured target table."""


def spec_for(table: str, specs: dict[str, TableSpec] | None = None) -> TableSpec:
    """Choose the spec by upper-cased table name; a clear error if none."""
    specs = BUSINESS_SPECS if specs is None else specs
    key = table.upper()
    if key.startswith("STG_") or key.startswith("RAW_"):
        key = key[4:]
    if key not in specs:
        raise UnknownTableError(
            f"no merge spec for table {table!r}; known: {', '.join(sorted(specs))}")
    return specs[key]


def spec_from_schema(name: str, schema: T.StructType, keys, updated_column: str,
                     created_column: str | None = None) -> TableSpec:
    """A spec for any table whose business columns are given by a schema."""
    return TableSpec(name.upper(), tuple(keys),
                     tuple((f.name, f.dataType) for f in schema.fields),
                     updated_column=updated_column,
                     created_column=created_column or "__no_created_column__",
                     order_columns=(updated_column, "_ingestion_timestamp"))


# ---------------------------------------------------------------------------
# Control tables.  Column names and allowed values are fixed values that
# must equal the reference's control-table definitions.
# ---------------------------------------------------------------------------
LOAD_TYPES = ("FULL", "CDC", "INCREMENTAL")
SOURCE_TYPES = ("SQLSERVER", "CSV", "API", "PARQUET")
RULE_TYPES = ("NOT_NULL", "UNIQUENESS", "RANGE", "REGEX", "REFERENTIAL", "THRESHOLD", "CUSTOM")
RULE_ACTIONS = ("QUARANTINE", "REJECT", "WARN", "FLAG")
SEVERITIES = ("HIGH", "MEDIUM", "LOW")
RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILED", "PARTIAL", "SKIPPED")
DQ_STATUSES = ("PASS", "FAIL", "WARN")
ERROR_TYPES = ("EXTRACTION", "TRANSFORMATION", "LOAD", "DQ", "WATERMARK", "CONNECTION", "UNKNOWN")

PIPELINE_CONFIG_SCHEMA = schema_of(
    "pipeline_id int, pipeline_name string, source_type string, source_server string, "
    "source_database string, source_schema string, source_table string, source_query string, "
    "load_type string, cdc_column string, cdc_column_type string, primary_key_columns string, "
    "sink_schema string, sink_table string, adls_container string, adls_folder_path string, "
    "file_format string, batch_size int, dq_enabled boolean, is_active boolean, "
    "retry_count int, parallel_copy boolean, depends_on_pipeline string, "
    "schedule_frequency string, schedule_interval int, created_date timestamp_ntz, "
    "modified_date timestamp_ntz, created_by string")

# Defaults of the config table (applied by ``config_defaults``).
CONFIG_DEFAULTS = {"file_format": "PARQUET", "batch_size": 100000, "dq_enabled": True,
                   "is_active": True, "retry_count": 3, "parallel_copy": False,
                   "schedule_interval": 1, "created_by": "SYSTEM"}

DQ_RULES_SCHEMA = schema_of(
    "rule_id int, pipeline_name string, rule_name string, rule_type string, "
    "column_name string, rule_expression string, min_value string, max_value string, "
    "regex_pattern string, expected_value string, threshold_pct decimal(5,2), "
    "ref_table string, ref_column string, action_on_failure string, severity string, "
    "error_message string, rule_order int, is_active boolean, created_date timestamp_ntz")

RULE_DEFAULTS = {"action_on_failure": "QUARANTINE", "severity": "HIGH", "rule_order": 1,
                 "is_active": True}

# Append-only logs that replace row UPDATEs of the control database.
RUN_EVENT_SCHEMA = schema_of(
    "event string, run_id string, pipeline_name string, source_table string, "
    "event_time timestamp_ntz, status string, rows_extracted bigint, rows_passed_dq bigint, "
    "rows_failed_dq bigint, rows_loaded bigint, watermark_start string, watermark_end string, "
    "adf_pipeline_name string, adf_trigger_name string, error_message string")

WATERMARK_LOG_SCHEMA = schema_of(
    "pipeline_name string, source_table string, cdc_column string, watermark_value string, "
    "watermark_type string, rows_loaded bigint, updated_at timestamp_ntz, seq bigint")

ERROR_LOG_SCHEMA = schema_of(
    "error_id string, run_id string, pipeline_name string, source_table string, "
    "error_type string, error_message string, error_details string, "
    "adf_activity_name string, created_date timestamp_ntz, is_resolved boolean, "
    "resolved_by string, resolved_date timestamp_ntz, resolution_notes string")

SCHEMA_LOG_SCHEMA = schema_of(
    "run_id string, pipeline_name string, batch_id string, column_name string, change string, "
    "from_type string, to_type string, logged_at timestamp_ntz")

DQ_RESULTS_SCHEMA = schema_of(
    "run_id string, pipeline_name string, source_table string, rule_id int, "
    "rule_name string, rule_type string, column_name string, total_records bigint, "
    "passed_records bigint, failed_records bigint, pass_rate_pct decimal(5,2), "
    "status string, action_taken string, dq_file_path string, run_date timestamp_ntz, "
    # ours: the rule's severity at evaluation time, so a later change to the
    # rule does not rewrite the history of results
    "severity string")
