"""Sources and sinks: raw delimited text, layer tables, result files, fixture."""

from tiermill.sources.fixture import raw_from_tpch, write_raw_csv
from tiermill.sources.layers import (
    ensure_layer,
    layer_path,
    list_tables,
    preview,
    read_layer,
    read_table,
    register_table,
    write_layer,
)
from tiermill.sources.raw_csv import SourceNotFound, read_raw
from tiermill.sources.results import export_result, read_result

__all__ = [
    "SourceNotFound",
    "ensure_layer",
    "export_result",
    "layer_path",
    "list_tables",
    "preview",
    "raw_from_tpch",
    "read_layer",
    "read_raw",
    "read_result",
    "read_table",
    "register_table",
    "write_layer",
    "write_raw_csv",
]
