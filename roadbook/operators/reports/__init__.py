"""Reporting queries over the marts and dimensions."""
