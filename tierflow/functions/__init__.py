"""Column -> Column helpers (scalar cleaning, typing, keys)."""

from tierflow.functions.clean import *  # noqa: F401,F403
