"""Errors, with a mark for those that a second try may cure."""

from __future__ import annotations


class BridgeError(Exception):
    """Base class. ``retriable`` says whether the same call may succeed later."""

    retriable = False


class InvalidOption(BridgeError):
    """An option can't be read or contradicts another."""


class UnsupportedType(BridgeError):
    """A type has no counterpart on the other side."""


class UnsupportedExpression(BridgeError):
    """An expression can't be pushed to a remote system."""


class SchemaMismatch(BridgeError):
    """Data and declared schema differ."""


class UndefinedTable(BridgeError):
    """A table doesn't exist."""


class ReadOnlyTable(BridgeError):
    """The table was opened for reading."""


class ConstraintViolation(BridgeError):
    """Rows break a uniqueness constraint."""


class RemoteFailure(BridgeError):
    """The remote system failed for a reason that may pass, such as a lock or a lost connection."""

    retriable = True


#: Words in driver messages that tell of passing trouble.
_PASSING = ("locked", "busy", "timeout", "timed out", "connection", "could not set lock", "temporarily")


def classify(error: Exception) -> BridgeError:
    """A driver's error as one of ours: mistakes in SQL, plans and schemas are not retriable."""
    if isinstance(error, BridgeError):
        return error
    text = str(error).lower()
    if any(w in text for w in _PASSING):
        return RemoteFailure(str(error))
    if "no such table" in text or ("table" in text and "does not exist" in text):
        return UndefinedTable(str(error))
    return BridgeError(str(error))
