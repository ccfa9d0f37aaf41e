from rankfold.sources.tables import (load_table, corpus, text_queries, doc_vectors, query_vectors)

__all__ = ["load_table", "corpus", "text_queries", "doc_vectors", "query_vectors"]
