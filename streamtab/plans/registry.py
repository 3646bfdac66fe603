"""All registered queries of the main library and their SQL."""

from __future__ import annotations

from . import catalog, flows, oracle, streams, surface

QUERIES = {**catalog.QUERIES, **flows.QUERIES, **surface.QUERIES}
ORACLE_SQL = {**oracle.ORACLE_SQL, **flows.ORACLE_SQL, **surface.ORACLE_SQL}
STREAM_QUERIES = {**streams.STREAM_QUERIES, **flows.STREAM_QUERIES, **surface.STREAM_QUERIES}
STREAM_ORACLE_SQL = {**streams.STREAM_ORACLE_SQL, **flows.stream_oracles(oracle.ORACLE_SQL), **surface.STREAM_ORACLE_SQL}

__all__ = ["QUERIES", "ORACLE_SQL", "STREAM_QUERIES", "STREAM_ORACLE_SQL"]
