"""All queries of the engine, by name, with their SQL where SQL can express them."""

from __future__ import annotations

from wayline.plans import anchoring, archives, audits, chats, checks, completion, conclusions, contracts, defects, drawing, freezing, golden, judgements, matching, metrics, observations, prompts, relabel, relational, reports, rewriting, sampling, sequences, sessions, snapshots, tasks, texts, traces, urls  # noqa: F401
from wayline.plans.catalog import ORACLES, QUERIES  # noqa: F401

FLAGSHIP = "f1_noise_profile"
