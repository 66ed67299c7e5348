"""All registered queries of the library's own operators, by name, and their SQL."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("text", "dedup", "windows", "chat", "extra", "samples", "more")
QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _name in FAMILIES:
    _m = import_module(f"{__package__}.{_name}")
    QUERIES |= _m.QUERIES
    ORACLES |= _m.ORACLES
FLAGSHIP = "F14_task_cascade"
