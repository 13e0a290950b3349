"""Stages, their orchestration, and the registered queries."""
