"""Models and reports composed from the operators."""
