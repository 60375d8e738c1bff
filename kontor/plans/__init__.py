"""Whole tables and reports, composed of the operators."""
