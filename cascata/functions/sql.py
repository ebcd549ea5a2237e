"""The functions by name in SQL.

``register`` creates Spark SQL functions (their bodies are SQL, which Catalyst inlines into the calling query: no Python
runs) with the same rules as the column expressions of this package:

    split_tokens(line)          ARRAY<STRING>   comma tokens, trailing empty ones dropped
    split_lines(text)           ARRAY<STRING>   lines as a line reader returns them
    decode_text(payload)        STRING          UTF-8 bytes, malformed ones as U+FFFD
    range_outcome(num)          STRING          ack within 1 to 10, else fail
    decode_outcome(payload)     STRING          fail without a payload
    add_user(name)              STRING          "add user:" and the name
    tokens(line)                TABLE (word STRING)     a row per comma token
    text_tokens(text)           TABLE (word STRING)     a row per comma token of every line

Table functions are called as ``FROM docs, LATERAL text_tokens(docs.text)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cascata.functions.routing import ACK, FAIL, RANGE_HIGH_INCLUSIVE, RANGE_LOW_EXCLUSIVE
from cascata.functions.text import NULL_TEXT, TOKEN_SEPARATOR
from cascata.operators.requests import ADD_USER_PREFIX

_KEPT = f"trim(TRAILING '{TOKEN_SEPARATOR}' FROM line)"
_PARTS = "split(CASE WHEN instr(text, '\\r') > 0 THEN regexp_replace(text, '\\r\\n?', '\\n') ELSE text END, '\\n', -1)"

SCALARS = {
    "split_tokens": ("line STRING", "ARRAY<STRING>", f"""
        CASE WHEN line IS NULL THEN CAST(NULL AS ARRAY<STRING>)
             WHEN {_KEPT} = '' AND line <> '' THEN CAST(array() AS ARRAY<STRING>)
             ELSE split({_KEPT}, '{TOKEN_SEPARATOR}', -1) END"""),
    "split_lines": ("text STRING", "ARRAY<STRING>", f"""
        CASE WHEN text = '' THEN CAST(array() AS ARRAY<STRING>)
             WHEN try_element_at({_PARTS}, -1) = '' THEN slice({_PARTS}, 1, size({_PARTS}) - 1)
             ELSE {_PARTS} END"""),
    "decode_text": ("payload BINARY", "STRING", "make_valid_utf8(CAST(payload AS STRING))"),
    "range_outcome": ("num BIGINT", "STRING",
                      f"CASE WHEN num > {RANGE_LOW_EXCLUSIVE} AND num <= {RANGE_HIGH_INCLUSIVE} THEN '{ACK}' ELSE '{FAIL}' END"),
    "decode_outcome": ("payload BINARY", "STRING", f"CASE WHEN payload IS NULL THEN '{FAIL}' ELSE '{ACK}' END"),
    "add_user": ("name STRING", "STRING", f"'{ADD_USER_PREFIX}' || coalesce(name, '{NULL_TEXT}')"),
}

# A generator takes no SQL function as its argument, so the bodies stand here themselves; and one generator, not two, so
# that a lateral call stays a narrow step (over a derived table it would become a join with the distinct texts).
TABLES = {
    "tokens": ("line STRING", "word STRING", f"SELECT explode({SCALARS['split_tokens'][2]})"),
    "text_tokens": ("text STRING", "word STRING",
                    f"SELECT explode(flatten(transform({SCALARS['split_lines'][2]}, line -> {SCALARS['split_tokens'][2]})))"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session (temporary, replacing those of the same names); returns the names."""
    for name, (arguments, result, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    for name, (arguments, columns, body) in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({columns}) RETURN {body}")
    return [*SCALARS, *TABLES]
