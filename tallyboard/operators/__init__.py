"""Operators, each a function from DataFrame(s) to DataFrame."""
