"""Registry of end-to-end queries (one per operator) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from strandline.sources.fixtures import with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``oracle`` is DuckDB SQL over fx_* views."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = with_views(oracle)
        return fn
    return deco


def load_all() -> None:
    from strandline.plans import q_alignment, q_annotation, q_counting, q_coverage, q_dge, q_files, q_model, q_reads  # noqa: F401
