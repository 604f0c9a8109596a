"""All queries outside the language-model subpackage."""

from __future__ import annotations

import importlib

from foliomill.plans import corpus_queries

_MODULES = ("relational_queries", "aggregate_queries", "sequence_queries", "ledger_queries", "text_queries", "evidence_queries", "fidelity_queries", "record_queries")
_BOOKS = [importlib.import_module(f"foliomill.plans.{m}").book for m in _MODULES]
QUERIES = {**corpus_queries.QUERIES, **{n: q for b in _BOOKS for n, q in b.queries.items()}}
ORACLES = {**corpus_queries.ORACLES, **{n: s for b in _BOOKS for n, s in b.oracles.items()}}
COVERS = {n: c for b in _BOOKS for n, c in b.covers.items()}
