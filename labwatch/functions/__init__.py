"""Column builders. Each takes and returns ``Column`` and runs inside whole-stage codegen."""
