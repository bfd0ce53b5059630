"""Whole analyses built from the operators, one module per subject.

Each returns its results by name as DataFrames that run when they are used and
read only the columns they need. Intermediate tables that several results share
are written while the report is put together.
"""
