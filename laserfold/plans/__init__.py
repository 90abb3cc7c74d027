"""Chains of operators: product builds and serving queries."""
