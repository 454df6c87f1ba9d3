"""Imports every plan module once, which registers its queries."""

from importlib import import_module

NAMES = ["flagship", "bitemporal", "joins", "aggregates", "timeseries", "cleaning", "scalars", "texts", "evaluation", "groups"]


def load() -> None:
    for name in NAMES:
        import_module(f"censuskit.plans.{name}")
