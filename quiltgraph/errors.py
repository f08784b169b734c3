"""What the engine raises."""


class ConfigError(ValueError):
    """A configuration that cannot be run."""


class MappingError(ValueError):
    """A mapping that does not fit its rows."""


class ConflictError(RuntimeError):
    """Two writers of one graph."""
