"""Plans composed from the operators."""
