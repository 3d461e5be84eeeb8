"""Table builders and jobs composed from the functions and operators."""
