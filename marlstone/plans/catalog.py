"""All queries of the engine by name, with their SQL."""

from __future__ import annotations

from . import aggregation, cascades, chains, checks, classes, curation, documents, entities, evidence, extraction, facts, filters, geography, graph, joins, knowledge, layout, ledger, mentions, numbers, objects, ordering, refine, registries, state, studies, text, vectors  # noqa: F401
from .registry import COVERS, ORACLES, QUERIES

FLAGSHIP = "m_metric_distribution"
__all__ = ["COVERS", "FLAGSHIP", "ORACLES", "QUERIES"]
