"""Set, order and line operators."""
