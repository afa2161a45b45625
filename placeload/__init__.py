"""Spark-first loading of place tables: cell keys, JSON text, sinks, checks."""

from placeload.config import LoadConfig
from placeload.functions.curve import Box, curve_key, curve_ranges
from placeload.functions.geo import geo_cell
from placeload.functions.nested import stringify_nested
from placeload.operators.profile import (
    keep_sketches,
    kept_sketches,
    merge_sketches,
    sketch_profile,
    width_sketches,
)
from placeload.operators.quality import (
    check_constraints,
    column_types,
    constraint_violations,
    width_profile,
)
from placeload.operators.report import LoadReport
from placeload.operators.sharding import shard_by, shard_report
from placeload.operators.upsert import latest_by_key, upsert
from placeload.plans.drift import Step, adapted, apply_drift, drift, drift_frame
from placeload.plans.jobs import load_flat, load_places
from placeload.plans.ledger import ledger_table, new_files, settle, unsettled
from placeload.plans.places import append_cell_key, places_frame
from placeload.plans.sql import run_in_full, run_script, run_sql
from placeload.plans.tables import CATEGORIES, PLACES, ColumnDef, TableDef, create_or_replace
from placeload.sources.clustered import read_box, write_clustered
from placeload.sources.jdbc import (
    JdbcTarget,
    read_jdbc,
    table_exists,
    target_schema,
    write_jdbc,
)
from placeload.sources.parquet import read_table, row_cap
from placeload.sources.staging import Changes, apply_changes, publish, swap, upsert_jdbc
from placeload.sources.tables import replace_rows, upsert_table, write_sharded, write_table
from placeload.storage import materialize, scratch_path

__all__ = [
    "Box",
    "CATEGORIES",
    "Changes",
    "ColumnDef",
    "JdbcTarget",
    "LoadConfig",
    "LoadReport",
    "PLACES",
    "Step",
    "TableDef",
    "adapted",
    "append_cell_key",
    "apply_changes",
    "apply_drift",
    "check_constraints",
    "column_types",
    "constraint_violations",
    "create_or_replace",
    "curve_key",
    "curve_ranges",
    "drift",
    "drift_frame",
    "geo_cell",
    "keep_sketches",
    "kept_sketches",
    "latest_by_key",
    "ledger_table",
    "load_flat",
    "load_places",
    "materialize",
    "merge_sketches",
    "new_files",
    "places_frame",
    "publish",
    "read_box",
    "read_jdbc",
    "read_table",
    "replace_rows",
    "row_cap",
    "run_in_full",
    "run_script",
    "run_sql",
    "scratch_path",
    "settle",
    "shard_by",
    "shard_report",
    "sketch_profile",
    "stringify_nested",
    "swap",
    "table_exists",
    "target_schema",
    "unsettled",
    "upsert",
    "upsert_jdbc",
    "upsert_table",
    "width_profile",
    "width_sketches",
    "write_clustered",
    "write_jdbc",
    "write_sharded",
    "write_table",
]
