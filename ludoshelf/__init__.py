"""Catalogue analytics on Spark: landed store responses in, clean tables and nested records out."""

from ludoshelf.operators.catalogue import app_ids
from ludoshelf.plans.games import Collected, collect_games, game_documents
from ludoshelf.session import build_session
from ludoshelf.sources.landing import read_landing, write_documents, write_landing
from ludoshelf.sources.staging import Staging

__all__ = [
    "Collected",
    "Staging",
    "app_ids",
    "build_session",
    "collect_games",
    "game_documents",
    "read_landing",
    "write_documents",
    "write_landing",
]
