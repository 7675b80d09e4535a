"""End-to-end jobs: staging and load, mart refresh, alert run."""
