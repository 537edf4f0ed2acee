"""Column expressions. Built-in functions only, so they stay inside Catalyst."""
