"""Whole jobs: the extract job, the pre-flight job and the registered queries."""
