"""Registered queries by topic; ``load_all`` imports every topic once."""

from __future__ import annotations

import importlib

from agentlake.plans.registry import ORACLE, QUERIES

TOPICS = (
    "ledger_queries", "fulfil_queries", "scheduling_queries", "claims_queries", "retrieval_queries", "eval_queries", "model_queries", "io_queries", "storage_queries",
)


def load_all():
    for topic in TOPICS:
        importlib.import_module(f"agentlake.plans.{topic}")
    return QUERIES, ORACLE
