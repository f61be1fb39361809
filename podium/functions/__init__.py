"""Column-level helpers: built-in Spark expressions only (codegen-friendly)."""

from podium.functions.cast import (concat_time, date_text, dotted_number, parse_date_text,
                                   safe_cast, same_type_lit)
from podium.functions.keys import hash_split, sha256_bytes, sha256_hex
from podium.functions.text import (first_in, first_pos_in, flag_priority, item, join_range,
                                   normalize_ws, paren_capture, split_item, starts_with,
                                   strip_ws, tail, tokenize)

__all__ = [
    "concat_time", "date_text", "dotted_number", "parse_date_text", "safe_cast", "same_type_lit",
    "hash_split", "sha256_bytes", "sha256_hex",
    "first_in", "first_pos_in", "flag_priority", "item", "join_range", "normalize_ws",
    "paren_capture", "split_item", "starts_with", "strip_ws", "tail", "tokenize",
]
