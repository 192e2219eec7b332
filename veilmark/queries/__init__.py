"""Registered queries: one callable per operator and, where SQL can say it, the SQL."""

from veilmark.queries import (  # noqa: F401
    chunks, detection, evaluation, features, planted, prep, privacy, redaction, spans, synthetic, tokens, training,
)
from veilmark.queries.base import REGISTRY

__all__ = ["REGISTRY"]
