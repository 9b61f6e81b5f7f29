"""Composite jobs built from the operators (landing, Silver, Gold, checks, model)."""
