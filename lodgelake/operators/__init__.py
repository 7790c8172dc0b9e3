"""Generic relational operators composed from DataFrame primitives."""
