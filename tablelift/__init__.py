"""tablelift: move whole relational tables with Spark and prove that the copy is right."""

from tablelift.jobs import export_frame, export_table, export_tables, specs_of, verify_export
from tablelift.operators.project import apply_types, csv_text, physical, with_virtual
from tablelift.operators.results import audit, pending, results_ranked, run_summary, table_results
from tablelift.operators.rowhash import column_hashes, duplicates, pk_hash, with_row_hash
from tablelift.operators.treediff import tree_diff
from tablelift.operators.validate import diff, reconcile, validate
from tablelift.plans.options import ExportOptions
from tablelift.plans.refine import refine, refine_specs
from tablelift.plans.spec import ColumnSpec, TableSpec
from tablelift.plans.tasks import plan_tasks
from tablelift.plans.types import map_types
from tablelift.sinks.files import describe_export, read_export, write_csv, write_parquet
from tablelift.sinks.manifest import forget_export, read_refusals, record_history
from tablelift.sinks.publish import load_table, publish_table, publish_view
from tablelift.sources.catalog import discover
from tablelift.sources.chunks import Chunk, chunk_bounds, key_ledger
from tablelift.sources.scan import FileSource, JdbcSource, scan, scan_chunk, scan_chunked

__all__ = [
    "Chunk", "ColumnSpec", "ExportOptions", "FileSource", "JdbcSource", "TableSpec", "apply_types", "audit",
    "chunk_bounds", "column_hashes", "csv_text", "describe_export", "diff", "discover", "duplicates",
    "export_frame", "export_table", "export_tables", "forget_export", "key_ledger", "load_table", "map_types", "pending", "physical",
    "pk_hash", "plan_tasks", "publish_table", "publish_view", "read_export", "read_refusals", "reconcile", "record_history",
    "refine", "refine_specs",
    "results_ranked", "run_summary", "scan", "scan_chunk", "scan_chunked", "specs_of", "table_results", "tree_diff", "validate",
    "verify_export", "with_row_hash", "with_virtual", "write_csv", "write_parquet",
]
