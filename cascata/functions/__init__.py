"""Column expressions: tokenising, decoding, rendering and routing."""

from cascata.functions.routing import ACK, FAIL, decode_outcome, range_outcome
from cascata.functions.text import (as_text, column_text, decode_utf8, delimited, delimited_columns, is_valid_utf8,
                                    prefixed, split_lines, split_tokens, utc_timestamp_text)

__all__ = ["ACK", "FAIL", "as_text", "column_text", "decode_outcome", "decode_utf8", "delimited",
           "delimited_columns", "is_valid_utf8", "prefixed", "range_outcome", "split_lines", "split_tokens",
           "utc_timestamp_text"]
