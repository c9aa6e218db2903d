"""Whole flows over the operators, the test inputs, and the registered queries."""
