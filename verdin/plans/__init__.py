"""All registered queries."""

import importlib
import pkgutil

from verdin.plans.registry import QUERIES, TWINS

for _module in pkgutil.iter_modules(__path__):
    if _module.name != "registry":
        importlib.import_module(f"{__name__}.{_module.name}")

__all__ = ["QUERIES", "TWINS"]
