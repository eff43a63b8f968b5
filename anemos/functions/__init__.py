"""Column functions: no DataFrames in here."""

from .buckets import parse_interval, time_bucket
from .filenames import device_of, report_time_of, sample_time_of
from .formulas import FormulaError, formula_column
from .levels import confirmed_text, first_text, level_number, level_text
from .text import cell_text, number_text, spark_time_pattern, time_text

__all__ = [
    "FormulaError", "cell_text", "confirmed_text", "device_of", "first_text", "formula_column",
    "level_number", "level_text", "number_text", "parse_interval", "report_time_of",
    "sample_time_of", "spark_time_pattern", "time_bucket", "time_text",
]
