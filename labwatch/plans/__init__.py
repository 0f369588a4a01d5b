"""Dataflows built from the operators: laboratories, register, archive, panel, matrices, reports."""
