"""Column functions (scalar, date/time, aggregate) and row generators."""

from .scalar import *  # noqa: F401,F403
from .dates import *  # noqa: F401,F403
from .aggregates import *  # noqa: F401,F403
from .generators import *  # noqa: F401,F403
