"""Herd-record quality and reporting as PySpark DataFrame operators."""
