"""Whole jobs: one function per task, built from the operators."""
