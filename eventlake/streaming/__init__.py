"""Structured Streaming form of landing (file source with a checkpoint as ledger)."""
