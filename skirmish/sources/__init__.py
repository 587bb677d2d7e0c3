"""Fixed tables of the rules, and inputs derived from the events table."""
