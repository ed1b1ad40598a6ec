"""Registered corpus queries, each over its whole table, and their SQL where it can express them."""

from __future__ import annotations

import corpus_pipeline
from snaptrend.llm import (
    leaks,
    licenses,
    lines,
    mixing,
    near,
    neighbours,
    pages,
    prefixes,
    quality,
    runs,
    secret_scan,
    toxicity,
    transcripts,
)

_OPERATORS = (pages, lines, secret_scan, licenses, toxicity, transcripts, leaks, near, mixing, neighbours, quality, prefixes, runs)

QUERIES = {op.QUERY: op.query for op in _OPERATORS} | {"pipeline": corpus_pipeline.run}
ORACLE = {op.QUERY: op.ORACLE for op in _OPERATORS if getattr(op, "ORACLE", None)}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
