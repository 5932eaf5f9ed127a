"""Readers, curated state and sinks."""

from feedlake.sources.feeds import *  # noqa: F401,F403
from feedlake.sources.sinks import *  # noqa: F401,F403
from feedlake.sources.state import *  # noqa: F401,F403
