from shelfline.sources.clean import (
    NUMBERS,
    clean_items,
    clean_movements,
    clean_supply,
    clean_vendors,
    input_problems,
    parsed_numbers,
    type_movements,
    type_supply,
)
from shelfline.sources.raw import RawInputs, files_of, read_csv, read_raw, stream_files

__all__ = [
    "NUMBERS",
    "RawInputs",
    "clean_items",
    "clean_movements",
    "clean_supply",
    "clean_vendors",
    "input_problems",
    "parsed_numbers",
    "files_of",
    "read_csv",
    "read_raw",
    "stream_files",
    "type_movements",
    "type_supply",
]
