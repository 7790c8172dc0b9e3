"""Composite plans: silver cleaning, history, star schema, marts, analyses."""
