"""Sequence patterns over keyed, time-ordered rows."""

from tidewater.operators.pattern.api import match, step_array  # noqa: F401
from tidewater.operators.pattern.spec import Pattern, PatternError, Running, Skip, begin  # noqa: F401
