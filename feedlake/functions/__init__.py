"""Column -> Column expressions."""

from feedlake.functions.arrays import *  # noqa: F401,F403
from feedlake.functions.columns import *  # noqa: F401,F403
from feedlake.functions.numeric import *  # noqa: F401,F403
from feedlake.functions.structs import *  # noqa: F401,F403
from feedlake.functions.text import *  # noqa: F401,F403
