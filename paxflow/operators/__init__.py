"""Relational operators over the passenger-leg table, all DataFrame -> DataFrame."""
