"""Composed jobs and dashboard queries built from the operators."""
