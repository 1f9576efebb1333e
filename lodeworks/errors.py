"""Errors raised by the package; each names what the caller has to fix."""


class LoadError(ValueError):
    """A load was declared or fed in a way that no retry can make succeed."""


class NullKeyError(LoadError):
    """A merge key column holds a null (or is missing) on either side."""


class DuplicateKeyError(LoadError):
    """A keyed batch repeats a key and gives no row order to pick the last row by."""


class SchemaConflictError(LoadError):
    """Two schemas give one column types with no common wider type."""


class LayoutError(ValueError):
    """A partition or sort key that cannot be parsed or applied."""


class UndefinedTableError(LookupError):
    """A query or read names a table the dataset does not hold."""


class UndefinedDatasetError(LookupError):
    """A pinned dataset directory is not there (or is not a dataset)."""


class ConcurrentPublishError(RuntimeError):
    """Another writer published the same table version first."""


class IncompleteReadError(RuntimeError):
    """A read delivered fewer or more rows than the table is known to hold."""


class UnverifiableReadError(RuntimeError):
    """The table carries no authoritative row count to check a read against."""
