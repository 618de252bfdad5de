"""All core queries and their SQL."""

from __future__ import annotations

from strandloom.plans import annotation_queries, blueprint_queries, compare_queries, completed_queries, feature_queries, file_queries, model_queries, more_queries, problem1, problem3, problem6, read_queries, sequence_queries, stream_queries

_MODULES = (annotation_queries, blueprint_queries, compare_queries, completed_queries, feature_queries, file_queries, model_queries, more_queries, problem1, problem3, problem6, read_queries, sequence_queries, stream_queries)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in m.ORACLES.items()}
flagship = compare_queries.a1_gene_classes
