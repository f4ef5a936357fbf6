"""Every query of the engine's own operators, with its SQL."""

from folioframe.plans import book_queries, structure_queries, text_queries, validation_queries

_PARTS = (text_queries, structure_queries, validation_queries, book_queries)
QUERIES: dict = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
ORACLES: dict = {k: v for p in _PARTS for k, v in p.ORACLES.items()}
