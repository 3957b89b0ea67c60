"""Connected components, as the library has them."""

from larkspur.operators.components import connected

__all__ = ["connected"]
