"""Import every module that registers queries of this subpackage."""

from mercato.llm import audit_queries, class_queries, dedup_queries, leak_queries, rule_queries, secret_queries, shard_queries, token_queries, url_queries, vector_queries  # noqa: F401
from mercato.llm.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
