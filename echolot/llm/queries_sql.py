"""The operators' queries in SQL, where SQL can express them."""

from __future__ import annotations

SQL: dict[str, str] = {}
