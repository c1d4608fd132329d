"""Structured Streaming forms of the operators (K14 and the stateful folds)."""
