"""Names and texts as SQL, whatever characters they hold."""

from __future__ import annotations


def sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_name(value: str) -> str:
    return "`" + value.replace("`", "``") + "`"
