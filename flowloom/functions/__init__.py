"""Column-to-column functions; all of them are built-in Spark expressions."""

from flowloom.functions.dates import *  # noqa: F401,F403
from flowloom.functions.metrics import *  # noqa: F401,F403
from flowloom.functions.network import *  # noqa: F401,F403
from flowloom.functions.text import *  # noqa: F401,F403
