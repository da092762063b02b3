"""Registers the queries of the training-text operators."""

from __future__ import annotations

import importlib
import warnings

MODULES = ["p1_quality", "p2_repetition", "p3_markup", "p4_near", "p5_canonical", "p6_turns", "p7_forms", "p8_encode", "p9_leaks", "p10_residue"]


def collect(what: str) -> dict:
    """What all modules give under a name; a module that can't be imported gives nothing."""
    out: dict = {}
    for name in MODULES:
        try:
            out |= getattr(importlib.import_module(f"{__package__}.{name}"), what, {})
        except ImportError as e:
            warnings.warn(f"{name} left out: {e}", stacklevel=2)
    return out
