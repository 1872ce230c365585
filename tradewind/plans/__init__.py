"""Dataset builders and the registered queries made from the operators."""
