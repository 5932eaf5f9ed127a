"""DataFrame -> DataFrame relational operators."""

from feedlake.operators.aggregates import *  # noqa: F401,F403
from feedlake.operators.frames import *  # noqa: F401,F403
from feedlake.operators.generators import *  # noqa: F401,F403
from feedlake.operators.joins import *  # noqa: F401,F403
