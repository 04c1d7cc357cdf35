"""Column functions: ``Column -> Column``, no shuffles and no actions."""
