"""Canonical JSON of rows: names in order, no spaces, empty texts and nulls kept, characters beyond ASCII as they are."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters that JSON writes in a short form.
_SHORT = {"\\": "\\\\", '"': '\\"', "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}


def json_text(text: Column) -> Column:
    """A text as a JSON string; null is ``null``."""
    escaped = text
    for char, short in _SHORT.items():
        escaped = F.replace(escaped, F.lit(char), F.lit(short))
    for code in range(32):
        if chr(code) not in _SHORT:
            escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    safe = F.when(text.rlike('[\\x00-\\x1f"\\\\]'), escaped).otherwise(text)
    return F.when(text.isNull(), "null").otherwise(F.concat(F.lit('"'), safe, F.lit('"')))


def canonical_json(columns: list[str]) -> Column:
    """The columns, as texts, as one JSON object."""
    parts = [F.concat(F.lit(f'"{c}":'), json_text(F.col(c).cast("string"))) for c in sorted(columns)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
