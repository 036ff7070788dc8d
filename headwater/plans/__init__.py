"""The operators bound to the benchmark tables, each with its SQL twin.

Importing this package fills :data:`headwater.plans.registry.REGISTRY`.
"""

from importlib import import_module

MODULES = ("reporting", "catalogue", "matching", "reshaping", "rasters", "vectors", "files", "feeds")

for _name in MODULES:
    import_module(f"headwater.plans.{_name}")
