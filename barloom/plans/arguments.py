"""Checks of user arguments."""

from __future__ import annotations

from barloom.functions.returns import chosen_bases
from barloom.schemas import BASIS_OPEN, BASIS_PREV

FULL, INCREMENTAL = "full", "incremental"


def check_mode(mode: str) -> str:
    if mode not in (FULL, INCREMENTAL):
        raise ValueError(f"mode must be 'full' or 'incremental', not {mode!r}")
    return mode


def one_mode(full: bool = False, incremental: bool = False) -> str:
    if full == incremental:
        raise ValueError("choose exactly one of full and incremental")
    return FULL if full else INCREMENTAL


def one_basis(open_close: bool = False, close_close: bool = False) -> str:
    if open_close == close_close:
        raise ValueError("choose exactly one of open_close and close_close")
    return BASIS_OPEN if open_close else BASIS_PREV


def check_basis(basis: str) -> str:
    chosen_bases(basis)
    return basis


def check_text(name: str, value: str | None) -> str:
    if value is None or not value.strip():
        raise ValueError(f"{name} is required")
    return value
