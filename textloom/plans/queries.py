"""Import every plan module so its queries register, then expose the registry."""

from __future__ import annotations

from . import bpe_plans, metrics_plans, order_plans, select_plans, sequence_plans, source_plans, stream_plans, text_plans, training  # noqa: F401
from .registry import REGISTRY


def queries():
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
