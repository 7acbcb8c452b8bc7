"""Column-level functions (native Spark expressions, no Python UDFs)."""

from postlens.functions.scalars import *  # noqa: F401,F403
from postlens.functions.predicates import *  # noqa: F401,F403
