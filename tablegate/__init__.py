"""Read and write warehouse tables from code, as Spark DataFrame operators."""

from tablegate.functions.kinds import assert_supported_types, kind_of
from tablegate.functions.units import convert_size
from tablegate.functions.widening import can_widen, set_exact, upgrade_to
from tablegate.operators.access import (
    ID_ID_SIM,
    ID_ID_WEIGHT,
    as_rows,
    data_columns,
    first_long_long_double,
    get_map,
    null_sentinels,
    require_type,
    rows_from_positions,
)
from tablegate.operators.catalog import partition_listing
from tablegate.operators.limit import limit_rows
from tablegate.operators.lines import format_lines
from tablegate.operators.observe import Progress, drain_watched, observe_rows, observe_success, read_metrics
from tablegate.operators.schema import TableSchema, table_schema
from tablegate.operators.stats import (
    file_stats,
    partition_stats,
    selection_stats,
    stored_selection_stats,
    stored_stats,
)
from tablegate.plans.jobs import (
    input_benchmark,
    map_only_write,
    output_job,
    sweep,
    tail,
    tail_parse_only,
)
from tablegate.session import tune_session
from tablegate.sinks.bounded import bounded_by_bytes, row_bytes
from tablegate.sinks.checks import OutputCheckError, check_output
from tablegate.sinks.tables import Output, new_rows, write_outputs, write_profiles, write_table
from tablegate.sinks.text import append_statistics, write_delimited, write_lines
from tablegate.sources.faults import malformed_rows, skipped_files, split_malformed
from tablegate.sources.formats import FormatRule, UnknownFormatError, read_by_format
from tablegate.sources.partitions import list_files, list_partitions
from tablegate.sources.tables import FormatGroup, read_mixed_formats, read_profiles, read_table
from tablegate.spec import (
    TAB_SEPARATED,
    DelimitedFormat,
    ReadSpec,
    WriteSpec,
    qualified_name,
)

__all__ = [
    "ID_ID_SIM", "ID_ID_WEIGHT", "TAB_SEPARATED", "DelimitedFormat", "FormatGroup", "FormatRule",
    "Output", "OutputCheckError", "Progress", "ReadSpec", "TableSchema", "UnknownFormatError",
    "WriteSpec", "append_statistics", "as_rows", "assert_supported_types", "bounded_by_bytes", "can_widen",
    "check_output", "convert_size", "data_columns", "drain_watched", "file_stats",
    "first_long_long_double", "format_lines", "get_map", "input_benchmark", "kind_of", "limit_rows",
    "list_files", "list_partitions", "malformed_rows", "map_only_write", "new_rows",
    "null_sentinels", "observe_rows", "observe_success", "output_job", "partition_listing",
    "partition_stats", "qualified_name", "read_by_format", "read_metrics", "read_mixed_formats",
    "read_profiles", "read_table", "require_type", "row_bytes", "rows_from_positions", "selection_stats",
    "set_exact", "skipped_files", "split_malformed", "stored_selection_stats", "stored_stats",
    "sweep", "table_schema", "tail", "tail_parse_only", "tune_session", "upgrade_to",
    "write_delimited", "write_lines", "write_outputs", "write_profiles", "write_table",
]
