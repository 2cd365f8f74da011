"""Column functions: every one is built from Catalyst expressions, unless its docstring says otherwise."""
