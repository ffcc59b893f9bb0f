"""Intermediate tables in the shared folder: the library's helper."""

from eddy.scratch import Scratch, delete

__all__ = ["Scratch", "delete"]
