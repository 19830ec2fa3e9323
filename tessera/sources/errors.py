"""Errors of the pipelines."""


class PipelineError(Exception):
    """Anything that ends the work on one document or issuer, and may be tried again."""


class CorruptDocument(PipelineError):
    """A file that isn't what it should be."""


class QuotaExceeded(PipelineError):
    """A search quota is used up; the run halts."""


class FallbackUnavailable(PipelineError):
    """Neither the source nor its landed copy can be read."""


class ExtractorMissing(PipelineError):
    """No extractor was given for a kind of document."""
