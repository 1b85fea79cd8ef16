"""All queries of the library's own operators, by name."""

from __future__ import annotations

from quillspan.plans import corpus_queries, lifecycle_queries, ordered_queries, orphan_queries, parser_queries

_MODULES = (corpus_queries, lifecycle_queries, ordered_queries, orphan_queries, parser_queries)

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in _MODULES for name, q in m.SQL.items()}
FLAGSHIP = "bm25_topk"
