"""Column functions: text parsing, path pieces and JSON look-ups."""

from salesmill.functions.json_find import json_find_all, json_find_first
from salesmill.functions.parsing import parse_date, parse_int, parse_number
from salesmill.functions.paths import company_of, decode_key, segment

__all__ = [
    "company_of",
    "decode_key",
    "json_find_all",
    "json_find_first",
    "parse_date",
    "parse_int",
    "parse_number",
    "segment",
]
