"""Market data and training data on Spark: ``update_dataset``, ``convert_dataset`` and quality checks."""

from .errors import DateAxisError, UpdateError
from .operators.checks import LEVELS, SUBJECTS, Context, Figure, Outcome, Problem, Sample, run_all
from .plans.convert import ConversionConfig, convert_dataset
from .plans.results import ConversionResult, Count, ObjectKind, UpdateResult
from .plans.update import Tolerance, UpdateConfig, update_dataset

__all__ = [
    "LEVELS", "SUBJECTS", "Context", "ConversionConfig", "ConversionResult", "Count", "DateAxisError", "Figure", "ObjectKind", "Outcome", "Problem", "Sample",
    "Tolerance", "UpdateConfig", "UpdateError", "UpdateResult", "convert_dataset", "run_all", "update_dataset",
]
