"""Column expressions: parsing, cleaning, predicates, labels."""
