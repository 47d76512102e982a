"""Declarative query plans."""
