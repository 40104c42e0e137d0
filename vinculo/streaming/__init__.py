"""Incremental intake."""

from vinculo.streaming.intake import take_new_files

__all__ = ["take_new_files"]
