"""Retail reconciliation jobs on Spark: bronze load, typing, key reconciliation,
currency and as-of cost, rotation, stock-outs, growth, margin and quality gates."""
