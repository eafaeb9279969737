"""Run and step status rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Status names of runs and steps.
PENDING, RUNNING, SUCCESS, FAILED, SKIPPED, DEAD = (
    "PENDING", "RUNNING", "SUCCESS", "FAILED", "SKIPPED", "DEAD",
)
FINISHED = (SUCCESS, FAILED, SKIPPED, DEAD)
RETRYABLE = (PENDING, FAILED)
MAX_ATTEMPTS = 3


def started_at(status: Column, ts: Column) -> Column:
    return F.when(status == RUNNING, ts)


def finished_at(status: Column, ts: Column) -> Column:
    return F.when(status.isin(*FINISHED), ts)


def final_status(succeeded: Column, attempts: Column, max_attempts: Column) -> Column:
    """Outcome of a finished run: a failure is final once the attempts are used up."""
    return (
        F.when(succeeded, SUCCESS)
        .when(attempts >= max_attempts, DEAD)
        .otherwise(FAILED)
    )
