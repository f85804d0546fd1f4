"""The jobs a user runs, as compositions of the operators."""
