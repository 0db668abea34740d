"""The two errors that callers tell apart."""


class UpdateError(Exception):
    """A delivery can't be applied; the history stays as it is."""


class DateAxisError(ValueError):
    """Labels of an axis are no days, repeat or are out of order."""
