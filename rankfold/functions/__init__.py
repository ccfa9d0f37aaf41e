from rankfold.functions.text import STOP_WORDS, TOKEN_PATTERN, tokenize, query_slug, interior_terms
from rankfold.functions.scoring import safe_div, rrf_term, softmax_positive, bm25_weight, idf

__all__ = ["STOP_WORDS", "TOKEN_PATTERN", "tokenize", "query_slug", "interior_terms",
           "safe_div", "rrf_term", "softmax_positive", "bm25_weight", "idf"]
