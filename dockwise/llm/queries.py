"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from dockwise.llm import bpe, collocations, embeddings, exact, html_text, line_rules, lm_scoring, merkle, packing, quality, secret_scan, simhash, warc

MODULES = [bpe, simhash, warc, exact, html_text, quality, embeddings, secret_scan, packing, lm_scoring, merkle, collocations, line_rules]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in getattr(module, "SQL", {}).items()}
