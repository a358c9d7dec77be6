"""Column-level helpers shared by every layer."""
from gridlake.functions.semantics import *  # noqa: F401,F403
