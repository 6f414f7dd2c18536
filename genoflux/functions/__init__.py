"""Column expressions: every scalar rule of the engine, in built-in functions."""
