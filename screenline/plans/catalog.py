"""All registered queries and their SQL twins."""

from __future__ import annotations

from screenline.plans import (
    access_queries,
    collect_queries,
    fulltext_queries,
    match_queries,
    quality_queries,
    run_queries,
    text_queries,
)

MODULES = tuple(
    m.query
    for m in (
        text_queries,
        match_queries,
        collect_queries,
        fulltext_queries,
        quality_queries,
        run_queries,
        access_queries,
    )
)


def queries() -> dict:
    return {n: q for m in MODULES for n, q in m.queries.items()}


def oracles() -> dict:
    return {n: s for m in MODULES for n, s in m.oracles.items()}
