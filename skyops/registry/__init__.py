"""The registered queries and their reference SQL."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_MODULES = ("catalog", "logs", "metrics", "health", "configs", "images",
            "streams")


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with the SQL that must give the same rows."""

    def add(fn):
        def run(spark, sf_dir):
            from skyops.session import prepare

            return fn(prepare(spark), str(sf_dir).rstrip("/"))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"skyops.registry.{m}")
