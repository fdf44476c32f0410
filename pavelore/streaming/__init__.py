"""Stateless stream steps. Each also runs on a batch DataFrame."""
