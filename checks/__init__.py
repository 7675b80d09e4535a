"""Queries over the shared test tables, with the SQL each one is compared against."""
