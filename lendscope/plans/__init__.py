"""Composed plans: the lazily derived frame graph, the staged end-to-end flow,
the query registry and the DuckDB oracle SQL."""
