"""Log ingest, framing, typing and egress as Spark DataFrame operators."""

__version__ = "0.1.0"
