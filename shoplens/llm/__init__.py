"""Training-data operators: ten corpus operators and their registered queries."""
