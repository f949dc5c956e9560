"""Creator qualification on Spark: landed JSON to snapshots, signals, tiers and handoff."""

from talentsift.rules import Rules

__all__ = ["Rules"]
