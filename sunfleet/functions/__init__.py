"""Column functions: every one takes and returns Spark columns and runs on the JVM."""

from .telemetry import *  # noqa: F401,F403
