"""Column-level functions (return ``Column`` objects, stay inside codegen)."""
