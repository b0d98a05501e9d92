"""millrace: batch ingestion and data quality as Spark DataFrame plans."""

from millrace.config import load_task
from millrace.operators.report import run_checks
from millrace.plans.task import run_task

__all__ = ["load_task", "run_checks", "run_task"]
