"""Imports every module with registered queries."""

import importlib

for _name in (
    "sources", "shaping", "joins", "aggregates", "windows", "scalars", "transit", "journeys", "texts", "models",
):
    importlib.import_module(f"tramline.plans.{_name}")
