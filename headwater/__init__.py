"""Watershed project analytics as Spark jobs over whole tables."""

from headwater.session import build_session, scratch_dir, ship

__all__ = ["build_session", "scratch_dir", "ship"]
