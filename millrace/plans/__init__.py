"""Registered queries over the test tables, each with the SQL it must agree with."""

from millrace.plans.registry import ORACLES, QUERIES  # noqa: F401
from millrace.plans import config, files, jobs, messages, meters, names, tracking  # noqa: F401
