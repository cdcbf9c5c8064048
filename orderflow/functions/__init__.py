"""Column functions (scalars, hashing, lanes)."""
from orderflow.functions.scalars import *  # noqa: F401,F403
