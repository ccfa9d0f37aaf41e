from rankfold.streaming.answer import fused, hashed, lexical, read_answers, snapshot_retriever, start_answering
from rankfold.streaming.ingest import compact_index, ingest_batch, load_ingested_index, snapshot, start_ingest

__all__ = ["ingest_batch", "load_ingested_index", "snapshot", "start_ingest", "compact_index",
           "start_answering", "read_answers", "lexical", "hashed", "fused", "snapshot_retriever"]
