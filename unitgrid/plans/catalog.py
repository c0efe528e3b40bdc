"""All registered queries."""

from unitgrid.plans import catalog_contract, catalog_pixels, catalog_shapes, catalog_streams  # noqa: F401
from unitgrid.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
