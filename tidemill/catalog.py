"""All queries of the market operators, by survey id, with the SQL they are held against."""

from __future__ import annotations

from importlib import import_module

from tidemill.plans import registry

MODULES = ("operators.bars", "operators.features", "operators.rules", "operators.asof", "operators.book", "operators.ladder", "operators.onset", "operators.model", "operators.events", "operators.text", "operators.names", "operators.checks", "operators.lifecycle", "operators.pipelines", "operators.sweeps", "sources.feeds", "sources.sinks", "sources.tails", "sources.pages", "sources.store")
for _m in MODULES:
    import_module(f"tidemill.{_m}")


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
