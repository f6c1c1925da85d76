"""All queries of the core, by name."""

from __future__ import annotations

from qirtas.plans import graph, ingest, pages, references, retrieval, text

MODULES = (text, retrieval, graph, pages, ingest, references)
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
ORACLES = {name: q for m in MODULES for name, q in m.ORACLES.items()}
FLAGSHIP = retrieval.q_search
