"""The jobs, each a function over the operators."""
