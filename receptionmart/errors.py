"""Exceptions raised by sources, jobs and quality checks."""

from __future__ import annotations


class MissingInputError(FileNotFoundError):
    """A required input path or table does not exist."""


class PublishConflictError(RuntimeError):
    """Another version was published while this one was being written."""


class DataQualityError(ValueError):
    """A quality check that must hold found violating rows; ``offenders`` is the frame of all of them, if given."""

    def __init__(self, message: str, offenders=None):
        super().__init__(message)
        self.offenders = offenders
