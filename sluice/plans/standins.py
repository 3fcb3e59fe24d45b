"""Change batches derived from the test tables, as SQL for either engine.

A "standard batch" turns one table into two snapshots of it:

* target: the current-state table after an earlier load (keys with
  ``k % 3 <> 0``), one row per key, every row marked INSERT at T0;
* raw: the next batch of RAW rows (keys with ``k % 3 = 0 OR k % 2 = 0``),
  with ``updated_at`` moved by ``k % 5 - 2`` days and ``_is_deleted`` on
  ``k % 11 = 0``.

Every row of the table is in one snapshot or both, so the merge sees
inserts, newer and stale updates, delete-flag flips and untouched rows in
fixed proportions at every scale.  ``_tb`` is a per-row number that makes
``_ingestion_timestamp`` distinct within a key, so the latest row is well
defined in both engines.
"""

from __future__ import annotations

from dataclasses import dataclass

from sluice.plans.dialect import Dialect
from sluice.spec import (BUSINESS_SPECS, STAGING_META_COLUMNS, TableSpec, _cols)

# Fixed instants of the derived history.
T0 = "2024-12-31 00:00:00"
NOW = "2025-01-01 00:00:00"
BATCH0 = "BATCH-20241231-000000"
BATCH1 = "BATCH-20250101-000000"

ORDERS_SPEC = TableSpec("ORDERS", ("o_orderkey",), _cols(
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz"))

LINEITEM_SPEC = TableSpec("LINEITEM", ("l_orderkey", "l_linenumber"), _cols(
    "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, "
    "l_quantity double, l_returnflag string, l_linestatus string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"))


@dataclass(frozen=True)
class StandIn:
    spec: TableSpec
    mod_key: str          # the key column the batch split uses
    source_table: str     # name used in lineage columns

    def base(self, d: Dialect) -> str:
        raise NotImplementedError


def _s(d: Dialect, x: str) -> str:
    return f"CAST({x} AS {d.str_type})"


class OrdersStandIn(StandIn):
    def base(self, d):
        return (f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
                f"o_orderpriority, o_orderdate AS created_at, o_orderdate AS updated_at, "
                f"CAST(0 AS BIGINT) AS _tb FROM {d.t('orders')}")


class LineitemStandIn(StandIn):
    def base(self, d):
        return (f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, "
                f"l_returnflag, l_linestatus, l_shipdate AS created_at, "
                f"l_shipdate AS updated_at, l_partkey * 100000 + l_suppkey AS _tb "
                f"FROM {d.t('lineitem')}")


class SuppliersStandIn(StandIn):
    def base(self, d):
        return (
            f"SELECT CAST(s.s_suppkey AS BIGINT) AS supplier_id, s.s_name AS supplier_name, "
            f"'SUP-' || {_s(d, 's.s_suppkey')} AS supplier_code, n.n_name AS country, "
            f"n.n_name AS city, lower(replace(s.s_name, '#', '')) || '@example.com' AS contact_email, "
            f"'+1-555-' || {_s(d, 's.s_nationkey')} AS contact_phone, "
            f"CASE WHEN s.s_acctbal < 0 THEN 'PREPAID' ELSE 'NET30' END AS payment_terms, "
            f"CASE WHEN s.s_acctbal < 0 THEN 'ON_HOLD' ELSE 'ACTIVE' END AS supplier_status, "
            f"CAST(s.s_nationkey % 5 + 1 AS DECIMAL(3,2)) AS rating, "
            f"{d.ts('2024-01-01 00:00:00')} AS created_at, "
            f"{d.add_days(d.ts('2024-01-01 00:00:00'), 's.s_suppkey % 300')} AS updated_at, "
            f"CAST(0 AS BIGINT) AS _tb "
            f"FROM {d.t('supplier')} s JOIN {d.t('nation')} n ON s.s_nationkey = n.n_nationkey")


class PurchaseOrdersStandIn(StandIn):
    def base(self, d):
        return (
            f"SELECT o_orderkey AS po_id, 'PO-' || {_s(d, 'o_orderkey')} AS po_number, "
            f"CAST(o_custkey % 100 + 1 AS BIGINT) AS supplier_id, "
            f"{d.to_date('o_orderdate')} AS order_date, "
            f"{d.to_date(d.add_days('o_orderdate', '14'))} AS expected_date, "
            f"CASE WHEN o_orderstatus = 'F' THEN {d.to_date(d.add_days('o_orderdate', '12'))} END "
            f"AS actual_date, o_orderstatus AS po_status, "
            f"CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, 'USD' AS currency, "
            f"CAST(o_custkey % 7 + 1 AS INT) AS line_items_count, "
            f"CAST(o_custkey % 10 AS BIGINT) AS warehouse_id, o_orderpriority AS notes, "
            f"o_orderdate AS created_at, o_orderdate AS updated_at, CAST(0 AS BIGINT) AS _tb "
            f"FROM {d.t('orders')}")


class InventoryStandIn(StandIn):
    def base(self, d):
        return (
            f"SELECT p_partkey AS inventory_id, p_partkey AS product_id, p_name AS product_name, "
            f"p_brand || '-' || {_s(d, 'p_partkey')} AS product_sku, "
            f"CAST(p_size % 5 AS BIGINT) AS warehouse_id, "
            f"'WH-' || {_s(d, 'p_size % 5')} AS warehouse_name, p_size AS quantity_on_hand, "
            f"CAST(p_size % 7 AS INT) AS quantity_reserved, "
            f"CAST(p_size - p_size % 7 AS INT) AS quantity_available, "
            f"CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost, CAST(10 AS INT) AS reorder_point, "
            f"CAST(p_size * 2 AS INT) AS reorder_quantity, "
            f"{d.to_date(d.add_days(d.ts('2024-06-01 00:00:00'), 'p_size'))} AS last_count_date, "
            f"{d.ts('2024-01-01 00:00:00')} AS created_at, "
            f"{d.add_days(d.ts('2024-01-01 00:00:00'), 'p_size')} AS updated_at, "
            f"CAST(0 AS BIGINT) AS _tb FROM {d.t('part')}")


class ShipmentsStandIn(StandIn):
    def base(self, d):
        return (
            f"SELECT l_orderkey * 10 + l_linenumber AS shipment_id, "
            f"'SH-' || {_s(d, 'l_orderkey')} || '-' || {_s(d, 'l_linenumber')} AS shipment_number, "
            f"l_orderkey AS po_id, 'CARRIER-' || {_s(d, 'l_suppkey % 5')} AS carrier_name, "
            f"'TRK' || {_s(d, 'l_partkey')} || '-' || {_s(d, 'l_suppkey')} AS tracking_number, "
            f"'US' AS origin_country, 'DE' AS dest_country, "
            f"{d.to_date('l_shipdate')} AS ship_date, "
            f"{d.to_date(d.add_days('l_shipdate', '5'))} AS expected_date, "
            f"CASE WHEN l_linestatus = 'F' THEN {d.to_date(d.add_days('l_shipdate', '4'))} END "
            f"AS actual_date, "
            f"CASE WHEN l_returnflag = 'R' THEN 'RETURNED' WHEN l_linestatus = 'F' THEN 'DELIVERED' "
            f"ELSE 'IN_TRANSIT' END AS shipment_status, "
            f"CAST(l_quantity AS DECIMAL(18,3)) AS weight_kg, CAST(l_quantity AS INT) AS total_pieces, "
            f"CAST(l_quantity * 2.5 AS DECIMAL(18,2)) AS freight_cost, "
            f"l_shipdate AS created_at, l_shipdate AS updated_at, "
            f"l_partkey * 100000 + l_suppkey AS _tb FROM {d.t('lineitem')}")


class SalesOrdersStandIn(StandIn):
    def base(self, d):
        return (
            f"SELECT o.o_orderkey AS order_id, 'SO-' || {_s(d, 'o.o_orderkey')} AS order_number, "
            f"o.o_custkey AS customer_id, c.c_name AS customer_name, "
            f"{d.to_date('o.o_orderdate')} AS order_date, "
            f"{d.to_date(d.add_days('o.o_orderdate', '3'))} AS ship_date, "
            f"CASE WHEN o.o_orderstatus = 'F' THEN {d.to_date(d.add_days('o.o_orderdate', '7'))} END "
            f"AS delivery_date, o.o_orderstatus AS order_status, "
            f"CAST(o.o_totalprice AS DECIMAL(18,2)) AS order_amount, "
            f"CAST(0 AS DECIMAL(18,2)) AS discount_amount, CAST(0 AS DECIMAL(18,2)) AS tax_amount, "
            f"CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount, 'USD' AS currency, "
            f"c.c_mktsegment AS sales_channel, r.r_name AS region, "
            f"o.o_orderdate AS created_at, o.o_orderdate AS updated_at, CAST(0 AS BIGINT) AS _tb "
            f"FROM {d.t('orders')} o JOIN {d.t('customer')} c ON o.o_custkey = c.c_custkey "
            f"JOIN {d.t('nation')} n ON c.c_nationkey = n.n_nationkey "
            f"JOIN {d.t('region')} r ON n.n_regionkey = r.r_regionkey")


STANDINS = {
    "orders": OrdersStandIn(ORDERS_SPEC, "o_orderkey", "orders"),
    "lineitem": LineitemStandIn(LINEITEM_SPEC, "l_orderkey", "lineitem"),
    "suppliers": SuppliersStandIn(BUSINESS_SPECS["SUPPLIERS"], "supplier_id", "supplier"),
    "purchase_orders": PurchaseOrdersStandIn(BUSINESS_SPECS["PURCHASE_ORDERS"], "po_id", "orders"),
    "inventory": InventoryStandIn(BUSINESS_SPECS["INVENTORY"], "inventory_id", "part"),
    "shipments": ShipmentsStandIn(BUSINESS_SPECS["SHIPMENTS"], "shipment_id", "lineitem"),
    "sales_orders": SalesOrdersStandIn(BUSINESS_SPECS["SALES_ORDERS"], "order_id", "orders"),
}


def target_sql(si: StandIn, d: Dialect) -> str:
    """STAGING after the earlier load: one row per key (latest by updated_at, _tb)."""
    spec = si.spec
    cols = ", ".join(spec.column_names)
    keys = ", ".join(spec.keys)
    k = si.mod_key
    return (
        f"SELECT {cols}, 'INSERT' AS _cdc_operation, {d.ts(T0)} AS _cdc_timestamp, "
        f"false AS _is_deleted, true AS _is_current, 'pl_{spec.name.lower()}' AS _pipeline_name, "
        f"'{BATCH0}' AS _batch_id, 'run-0' AS _run_id, {d.ts(T0)} AS _created_at, "
        f"{d.ts(T0)} AS _updated_at FROM ("
        f"SELECT b.*, row_number() OVER (PARTITION BY {keys} ORDER BY updated_at DESC, _tb DESC) "
        f"AS __rn FROM ({si.base(d)}) b WHERE {k} % 3 <> 0) x WHERE __rn = 1")


def raw_sql(si: StandIn, d: Dialect) -> str:
    """RAW rows of the next batch, with audit columns."""
    spec = si.spec
    k = si.mod_key
    cols = []
    for c in spec.column_names:
        if c == spec.updated_column:
            cols.append(f"{d.add_days(c, f'{k} % 5 - 2')} AS {c}")
        else:
            cols.append(c)
    return (
        f"SELECT {', '.join(cols)}, 'pl_{spec.name.lower()}' AS _pipeline_name, "
        f"'{BATCH1}' AS _batch_id, 'run-1' AS _run_id, 'CDC' AS _load_type, "
        f"'{si.source_table}.parquet' AS _source_file, ({k} % 11 = 0) AS _is_deleted, "
        f"{d.add_micros(d.ts(NOW), '_tb')} AS _ingestion_timestamp "
        f"FROM ({si.base(d)}) b WHERE {k} % 3 = 0 OR {k} % 2 = 0")


def merge_oracle_sql(si: StandIn, d: Dialect, target: str | None = None,
                     raw: str | None = None, now: str = NOW) -> str:
    """The MERGE restated in plain SQL: dedupe, full outer join, CASE per column."""
    spec = si.spec
    target = target or target_sql(si, d)
    raw = raw or raw_sql(si, d)
    bus = spec.column_names
    keys = list(spec.keys)
    meta = list(STAGING_META_COLUMNS)
    keys_csv = ", ".join(keys)
    src = (f"SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY {keys_csv} ORDER BY "
           f"{spec.updated_column} DESC NULLS FIRST, _ingestion_timestamp DESC NULLS FIRST) AS __rn "
           f"FROM ({raw}) r) z WHERE __rn = 1")
    t_cols = ", ".join([f"t.{c} AS t_{c}" for c in bus + meta] + ["1 AS t_present"])
    s_cols = ", ".join([f"s.{c} AS s_{c}" for c in bus + ["_pipeline_name", "_batch_id", "_run_id",
                                                         "_is_deleted"]] + ["1 AS s_present"])
    on = " AND ".join(f"tt.t_{k} = ss.s_{k}" for k in keys)
    ins = "tt.t_present IS NULL"
    upd = (f"(tt.t_present IS NOT NULL AND ss.s_present IS NOT NULL AND COALESCE("
           f"tt.t_{spec.updated_column} < ss.s_{spec.updated_column} OR "
           f"tt.t__is_deleted <> ss.s__is_deleted, false))")
    chg = f"({ins} OR {upd})"
    nw = d.ts(now)
    out = []
    for c in bus:
        if c in keys:
            out.append(f"CASE WHEN tt.t_present IS NOT NULL THEN tt.t_{c} ELSE ss.s_{c} END AS {c}")
        elif c == spec.created_column:
            out.append(f"CASE WHEN {ins} THEN ss.s_{c} ELSE tt.t_{c} END AS {c}")
        else:
            out.append(f"CASE WHEN {chg} THEN ss.s_{c} ELSE tt.t_{c} END AS {c}")
    out += [
        f"CASE WHEN {ins} THEN 'INSERT' WHEN {upd} THEN 'UPDATE' ELSE tt.t__cdc_operation END "
        f"AS _cdc_operation",
        f"CASE WHEN {chg} THEN {nw} ELSE tt.t__cdc_timestamp END AS _cdc_timestamp",
        f"CASE WHEN {chg} THEN ss.s__is_deleted ELSE tt.t__is_deleted END AS _is_deleted",
        f"CASE WHEN {chg} THEN true ELSE tt.t__is_current END AS _is_current",
        f"CASE WHEN {chg} THEN ss.s__pipeline_name ELSE tt.t__pipeline_name END AS _pipeline_name",
        f"CASE WHEN {chg} THEN ss.s__batch_id ELSE tt.t__batch_id END AS _batch_id",
        f"CASE WHEN {chg} THEN ss.s__run_id ELSE tt.t__run_id END AS _run_id",
        f"CASE WHEN {ins} THEN {nw} ELSE tt.t__created_at END AS _created_at",
        f"CASE WHEN {chg} THEN {nw} ELSE tt.t__updated_at END AS _updated_at",
    ]
    return (f"SELECT {', '.join(out)} FROM (SELECT {t_cols} FROM ({target}) t) tt "
            f"FULL OUTER JOIN (SELECT {s_cols} FROM ({src}) s) ss ON {on}")


def change_source_sql(si: StandIn, d: Dialect) -> str:
    """A source table after changes: the raw batch's business rows and delete flag."""
    spec = si.spec
    k = si.mod_key
    cols = [f"{d.add_days(c, f'{k} % 5 - 2')} AS {c}" if c == spec.updated_column else c
            for c in spec.column_names]
    return (f"SELECT {', '.join(cols)}, ({k} % 11 = 0) AS _is_deleted "
            f"FROM ({si.base(d)}) b WHERE {k} % 3 = 0 OR {k} % 2 = 0")


def staging_sql(si: StandIn, d: Dialect, source: str, pipeline: str, batch: str, run: str,
                now: str) -> str:
    """STAGING after a first load of ``source`` into an empty table (all INSERT)."""
    cols = ", ".join(si.spec.column_names)
    return (f"SELECT {cols}, 'INSERT' AS _cdc_operation, {d.ts(now)} AS _cdc_timestamp, "
            f"false AS _is_deleted, true AS _is_current, '{pipeline}' AS _pipeline_name, "
            f"'{batch}' AS _batch_id, '{run}' AS _run_id, {d.ts(now)} AS _created_at, "
            f"{d.ts(now)} AS _updated_at FROM ({source}) s")


def raw_rows_sql(si: StandIn, d: Dialect, source: str, pipeline: str, batch: str, run: str,
                 now: str, deleted: str = "false") -> str:
    cols = ", ".join(si.spec.column_names)
    return (f"SELECT {cols}, '{pipeline}' AS _pipeline_name, '{batch}' AS _batch_id, "
            f"'{run}' AS _run_id, {deleted} AS _is_deleted, {d.ts(now)} AS _ingestion_timestamp "
            f"FROM ({source}) s")


EVENTS_SPEC = TableSpec("EVENTS", ("user_id",), _cols(
    "user_id bigint, event_id bigint, event_type string, value double, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"))


@dataclass(frozen=True)
class SpecOnly:
    spec: TableSpec


def initial_raw_sql(si: StandIn, d: Dialect) -> str:
    """RAW rows whose initial load gives exactly ``target_sql``: the target's keys,
    stamped at T0, with ``_tb`` making the ingestion time distinct within a key."""
    spec = si.spec
    return (
        f"SELECT {', '.join(spec.column_names)}, 'pl_{spec.name.lower()}' AS _pipeline_name, "
        f"'{BATCH0}' AS _batch_id, 'run-0' AS _run_id, 'FULL' AS _load_type, "
        f"'{si.source_table}.parquet' AS _source_file, false AS _is_deleted, "
        f"{d.add_micros(d.ts(T0), '_tb')} AS _ingestion_timestamp "
        f"FROM ({si.base(d)}) b WHERE {si.mod_key} % 3 <> 0")
