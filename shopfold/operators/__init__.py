"""Relational operators of the order pipeline (DataFrame -> DataFrame)."""
