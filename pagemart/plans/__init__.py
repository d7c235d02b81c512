"""The jobs: ODS tables, cleaning pass, star schema, and the layer-by-layer run."""

from . import clean, dw, ods

__all__ = ["clean", "dw", "ods"]
