"""Errors raised by the engine. Messages carry rule names and counts, never data values."""


class ContractError(ValueError):
    """A contract, setting or rule definition is unusable."""


class DataRejected(ValueError):
    """Delivered data failed a check; nothing was applied or committed."""


class QualityFailed(DataRejected):
    """At least one required quality rule failed."""


class CommitConflict(RuntimeError):
    """Another writer committed the same version first."""


def listed(items, most=10):
    """The first of some names, and how many more there are."""
    items = list(items)
    rest = len(items) - most
    return ", ".join(map(str, items[:most])) + (f" and {rest} more" if rest > 0 else "")


def require(condition, message, error=ContractError):
    if not condition:
        raise error(message)
