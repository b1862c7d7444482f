"""All registered queries: importing the plan modules fills the registry."""

from __future__ import annotations

from trainprep.plans import registry
from trainprep.plans import corpus, dialogue, export, files, logs, sft, tokens  # noqa: F401

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
