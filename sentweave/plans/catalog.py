"""All queries over the reference's operations, by name, and their SQL."""

from sentweave.plans import corpus_queries, file_queries, link_queries, page_queries, text_queries

MODULES = (page_queries, text_queries, link_queries, corpus_queries, file_queries)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: statement for m in MODULES for name, statement in m.SQL.items()}
