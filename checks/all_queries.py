"""Imports every module that registers queries."""

from checks import q_core, q_features, q_io, q_profile, q_star  # noqa: F401
