"""Model and job plans composed from sources, functions and operators."""
