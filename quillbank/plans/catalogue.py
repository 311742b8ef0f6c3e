"""All queries of the item-bank operators, and their oracles."""

from __future__ import annotations

from quillbank.plans import audit_queries, bank_queries, change_queries, duplicate_queries, evidence_queries, extract_queries, intake_queries, law_queries, more_queries, paper_queries, text_queries, withdrawal_queries

_MODULES = (text_queries, bank_queries, duplicate_queries, audit_queries, change_queries, extract_queries, more_queries, law_queries, evidence_queries, withdrawal_queries, intake_queries, paper_queries)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL = {k: v for m in _MODULES for k, v in m.ORACLE_SQL.items()}
