"""Column builders over response bodies and text."""
