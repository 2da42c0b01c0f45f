"""Extracts, summary tables, figures and the publication run."""
