"""Registered queries, their SQL counterparts and a comparer."""
