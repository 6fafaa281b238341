"""Compositions of operators into whole profiles."""
