from flatspark.streaming.ingest import ingest_new_documents, ingested

__all__ = ["ingest_new_documents", "ingested"]
