"""Column functions; all stay inside whole-stage code generation unless they say otherwise."""
