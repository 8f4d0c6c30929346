from .follow import follow_silver
from .ingest import ingest, ingested

__all__ = ["follow_silver", "ingest", "ingested"]
