"""Parameterised SQL forms of the operators, and report runs that write results."""
