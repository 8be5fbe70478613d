"""Queries over the given tables, each with the SQL it must agree with."""

from talkmill.plans import (  # noqa: F401
    chats,
    conversations,
    files,
    grades,
    links,
    metrics,
    packs,
    streams,
    texts,
    webpages,
)
from talkmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
