"""Continuous forms of the stateless operators."""
