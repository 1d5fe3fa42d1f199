"""flatlake: dated flat-file ingestion and curation on Spark DataFrames."""

from .ingest import IngestRun, ingest, ingest_underlying
from .session import get_spark

__all__ = ["IngestRun", "get_spark", "ingest", "ingest_underlying"]
