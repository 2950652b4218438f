"""Small constructors for validation rules (name -> SQL boolean text).

Rules stay plain SQL text so they can be logged, stored next to quarantined
rows and replayed; any Spark SQL boolean expression is accepted. Column names
are backtick-quoted, so names such as ``a-b`` work.
"""

from __future__ import annotations

from collections.abc import Iterable


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def not_null(col: str) -> tuple[str, str]:
    return f"{col}_not_null", f"{quote(col)} IS NOT NULL"


def accepted_values(col: str, values: Iterable, allow_null: bool = False) -> tuple[str, str]:
    """``col IN (...)``; a NULL value fails unless ``allow_null``."""
    listed = ", ".join(sql_literal(v) for v in values)
    text = f"{quote(col)} IN ({listed})"
    if allow_null:
        text = f"{quote(col)} IS NULL OR {text}"
    return f"{col}_accepted_values", text


def rules(*pairs: tuple[str, str]) -> dict[str, str]:
    """Ordered rule set from (name, text) pairs; duplicate names are an error."""
    out: dict[str, str] = {}
    for name, text in pairs:
        if name in out:
            raise ValueError(f"duplicate rule name {name!r}")
        out[name] = text
    return out
