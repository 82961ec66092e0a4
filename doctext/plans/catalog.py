"""Importing this module registers every query."""

from . import q_index, q_more, q_pipeline, q_repair, q_search, q_state, q_stream, q_text, q_views  # noqa: F401
