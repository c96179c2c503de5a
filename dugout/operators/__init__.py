"""Generic, domain-free DataFrame operators."""
