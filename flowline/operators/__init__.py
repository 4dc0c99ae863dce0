"""Relational and training operators built from DataFrame primitives."""
