"""Relational operators: aggregates, marts, history, dashboard queries, quality checks, compaction."""
