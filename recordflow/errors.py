"""Exceptions raised by recordflow."""


class SpecError(ValueError):
    """A spec that cannot be compiled; raised before any row is read."""


class QualityGateError(RuntimeError):
    """A quality gate that did not hold; raised before any sink is written."""


class FlowFailed(RuntimeError):
    """A run that stopped; ``report`` holds what is known about it."""

    def __init__(self, message, report):
        super().__init__(message)
        self.report = report
