"""Rules as column expressions."""
