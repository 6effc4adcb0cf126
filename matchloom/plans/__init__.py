"""Stages and queries composed of operators."""
