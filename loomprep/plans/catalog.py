"""Imports every query module so the registry is complete."""

from . import (message_queries, mix_queries, select_queries, sequence_queries,  # noqa: F401
               text_queries, vector_queries, vision_queries)
from . import stream_queries  # noqa: E402,F401  (uses the SQL of the ones above)
from . import file_queries  # noqa: E402,F401
from .registry import ORACLE, QUERIES  # noqa: F401
