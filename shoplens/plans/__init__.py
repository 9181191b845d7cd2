"""Named queries. ``load`` imports every module of them and returns the registry."""

from importlib import import_module

MODULES = ("user_features", "search_history", "search_quality", "misspellings", "tables_and_files", "similarity", "vocabulary")


def load():
    for module in MODULES:
        import_module(f"shoplens.plans.{module}")
    return import_module("shoplens.plans.registry")
