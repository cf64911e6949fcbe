"""Queries of the text operators and of the pipeline, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from colmask.llm import chat, decontaminate, exact, pieces, quality, ranked, rules, sharding, simhash, tokens, toxicity, warc, whitening

_MODULES = (simhash, quality, tokens, pieces, warc, decontaminate, toxicity, rules, chat, sharding, whitening, ranked, exact)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
