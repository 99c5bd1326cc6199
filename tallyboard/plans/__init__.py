"""Compositions of operators: the programme's stages and a whole run."""
