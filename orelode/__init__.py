"""Medallion (bronze / silver / gold) data loads expressed as Spark DataFrame operators."""
