"""Formulas and factor builders: plain column expressions."""
