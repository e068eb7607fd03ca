"""Retail-sales cleaning, feature and KPI jobs written for Apache Spark."""

__version__ = "0.1.0"
