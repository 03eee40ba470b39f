"""Sources: parquet tables, text lines, delimited text, JSON, literal rows."""

from .delimited import (create_csv_table, declare_table, field, labelled_messages,
                        quoted_fields, read_declared, read_delimited,
                        read_semicolon_quoted, typed_split)
from .json import read_json, schema_rows
from .literal import literal_table, typed
from .positions import first_line_of_files, first_lines_of_files, positioned_lines
from .splits import read_lines_split, split_session, total_bytes
from .tables import TABLES, register_views, spread, table
from .text import (drop_lines_containing, drop_lines_equal, first_line, first_n_lines,
                   first_value, numbered_lines, read_lines)
from .variant import read_json_once

__all__ = [
    "create_csv_table", "declare_table", "field", "labelled_messages", "quoted_fields", "read_declared", "read_delimited",
    "read_semicolon_quoted", "typed_split", "read_json", "schema_rows", "literal_table",
    "typed", "TABLES", "register_views", "spread", "table", "drop_lines_containing",
    "drop_lines_equal", "first_line", "first_n_lines", "first_value", "numbered_lines",
    "read_lines", "read_lines_split", "split_session", "total_bytes", "first_line_of_files", "first_lines_of_files",
    "positioned_lines", "read_json_once",
]
