"""One exception hierarchy for the whole package."""


class QuireError(Exception):
    """Base of every error raised here."""


class ConfigurationError(QuireError):
    """A setting is missing or contradicts another."""


class SchemaError(QuireError):
    """A table lacks columns or has other types than declared."""


class RegistrationError(QuireError):
    """A document can't be registered."""


class SegmentationError(QuireError):
    """A document has no usable heading structure."""


class ChunkingError(QuireError):
    """Chunks exist already, or can't be built."""
