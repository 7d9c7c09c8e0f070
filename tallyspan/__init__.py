"""Spark-native analytics over the records AI agents and their gateways leave behind."""

__version__ = "0.1.0"
