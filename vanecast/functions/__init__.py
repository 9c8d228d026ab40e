"""Column functions: scalar features, calendar parts and the operator registry."""
