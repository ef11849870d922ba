"""Panelith: cross-sectional panel analytics as Spark DataFrame operators."""
