"""kestrel: user-level Spark DataFrame operators for raw tables to evaluated models."""

__version__ = "0.1.0"
