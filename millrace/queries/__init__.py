"""Named queries over the driver tables, and SQL that checks them."""

from __future__ import annotations

from millrace.queries import chains, checking, evidence, graphs, intake, lineages, matching, proof, runs, search, selecting, sources, time, verdicts
from millrace.queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "chains", "checking", "evidence", "graphs", "intake", "lineages", "matching", "proof", "runs", "search", "selecting", "sources", "time", "verdicts"]
