"""Layered-warehouse analytics as plain PySpark DataFrame operators."""

from layerwell.specs import TableSpec, warehouse_specs

__all__ = ["TableSpec", "warehouse_specs"]
