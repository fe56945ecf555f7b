from titlemart.sources.external import create_external_table
from titlemart.sources.load import Loaded, load_files, load_table
from titlemart.sources.paging import read_page
from titlemart.sources.parsing import BadRecordsError, parse_csv, parse_json_lines
from titlemart.sources.sampling import exact_sample, list_files

__all__ = [
    "BadRecordsError",
    "Loaded",
    "create_external_table",
    "exact_sample",
    "list_files",
    "load_files",
    "load_table",
    "parse_csv",
    "parse_json_lines",
    "read_page",
]
