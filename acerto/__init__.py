"""Reconcile instant payments reported by a settlement provider with an internal ledger."""

from acerto.config import ReconConfig

__all__ = ["ReconConfig"]
