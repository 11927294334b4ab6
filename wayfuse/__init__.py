"""Spark-native harmonisation, audit and analytics of road-crash feeds."""

from wayfuse.session import build_session, prepare, scratch_path

__all__ = ["build_session", "prepare", "scratch_path"]
