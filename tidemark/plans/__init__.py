"""Plans: the whole sync flow and the registered queries."""
