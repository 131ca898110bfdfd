"""What can go wrong, as exceptions with a hint for the operator."""

from __future__ import annotations


class MillraceError(Exception):
    """Base of all errors of this package."""

    hint = "see the message"


class InvalidArgument(MillraceError):
    hint = "correct the argument; nothing was changed"


class DecodeError(MillraceError):
    hint = "the payload doesn't fit the codec's schema"


class MissingField(MillraceError):
    hint = "the row lacks a value that the result needs"


class AlreadyRegistered(MillraceError):
    hint = "another process holds this worker's lease; wait until it is stale or use another id"


class TaskNotFound(MillraceError):
    hint = "the task isn't in a state in which this worker can lock it"


class StaleAcknowledgement(MillraceError):
    hint = "the task was taken over or acknowledged before; drop the result"


class WorkerNotRegistered(MillraceError):
    hint = "register the worker again; its lease is gone"


class SinkBufferFull(MillraceError):
    hint = "flush the sink before sending more"


class StoreConflict(MillraceError):
    hint = "another writer committed first; read again and retry"


class SchemaPending(MillraceError):
    hint = "run setup before using the store"


class ListenerError(MillraceError):
    hint = "the notification stream ended; start it again"


class StorageError(MillraceError):
    hint = "the store's folder can't be read or written"
