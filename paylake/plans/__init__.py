"""Stages, the command line, and the registered queries."""
