"""All registered queries with their SQL."""

from importlib import import_module

FLAGSHIP = "accident_table"
MODULES = ["accident", "cleaning", "joining", "profiling", "evaluation", "clusters", "learning", "checked", "shares", "streams", "files"]


def _collect(attribute: str) -> dict:
    out = {}
    for m in MODULES:
        part = getattr(import_module(f"kerbside.catalogue.{m}"), attribute)
        clash = set(out) & set(part)
        if clash:
            raise ValueError(f"query registered twice: {clash}")
        out |= part
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("SQL")
