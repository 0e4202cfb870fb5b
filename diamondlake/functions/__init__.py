"""Column functions: no joins, no Python workers, everything inside codegen."""
