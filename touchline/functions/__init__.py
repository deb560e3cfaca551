"""Column functions. All are native expressions, so they stay inside whole-stage code generation."""
