"""Errors raised by the jobs; every one is a `PipelineError`."""

from __future__ import annotations

from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from millrace.operators.quality import QualityReport


class PipelineError(Exception):
    """Base of all errors raised on purpose by this package."""


class ContractError(PipelineError):
    """A dataset is unknown or its contract is inconsistent."""


class ReadError(PipelineError):
    """A table could not be read."""


class LandingError(PipelineError):
    """A source could not be landed."""


class SchemaError(PipelineError):
    """A frame does not offer the columns its contract declares."""


class TransformError(PipelineError):
    """A conforming step failed."""


class QualityError(PipelineError):
    """The quality gate is shut; `report` says why."""

    def __init__(self, report: QualityReport) -> None:
        self.report = report
        super().__init__(
            f"{report.dataset_name}: {len(report.errors)} quality problem(s): "
            + "; ".join(report.errors)
        )
