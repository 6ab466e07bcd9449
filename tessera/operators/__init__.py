"""Operator library. Import the sub-modules directly, e.g.
``from tessera.operators import marts``."""
