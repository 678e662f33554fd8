"""Relational operators: de-duplication, merge, marts, indicators, audit."""
