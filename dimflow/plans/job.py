"""The batch job: load, build, reconcile, with an audit row per step."""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Callable, Collection
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import functions as F

from dimflow.operators.reconcile import Pair, all_passed, report
from dimflow.plans.star import Star, build_star
from dimflow.registry import TableSpec
from dimflow.session import configure, run_folder
from dimflow.sources import load
from dimflow.sources.readers import Source
from dimflow.sources.store import AUDIT_TABLES, RAW, Store


@dataclass(frozen=True)
class Job:
    """What a run works on."""

    store: Store
    source: Source
    specs: list[TableSpec]
    star: Star
    as_of: str
    run_id: str


@dataclass(frozen=True)
class Step:
    """A part of the job. ``work`` tells whether the data were found right; nothing follows a failed ``critical`` step."""

    name: str
    work: Callable[[Job], bool]
    critical: bool = False

    def attempt(self, job: Job) -> tuple[bool, str | None]:
        """Whether the data were found right, and the error if there was one."""
        try:
            return self.work(job), None
        except Exception as failure:  # it is for the caller to go on or not
            traceback.print_exc()
            return False, str(failure) or type(failure).__name__


@dataclass(frozen=True)
class JobResult:
    """How a run went: ``ok`` needs every step to succeed and every check to pass."""

    run_id: str
    ok: bool
    statuses: dict[str, str]


def _extract(job: Job) -> bool:
    load.run(job.store, job.source, job.specs)
    return True


def _transform(job: Job) -> bool:
    build_star(job.store, job.star, job.as_of, job.run_id)
    return True


def _validate(job: Job) -> bool:
    return reconcile(job.store, job.source, job.specs, job.run_id)


STEPS = (Step("extract", _extract, critical=True), Step("transform", _transform), Step("validate", _validate))


def plan_steps(names: Collection[str] | None = None) -> list[Step]:
    """The named steps, all without names, in the job's order."""
    unknown = set(names or ()) - {step.name for step in STEPS}
    if unknown:
        raise ValueError(f"no such step: {', '.join(sorted(unknown))}")
    return [step for step in STEPS if names is None or step.name in names]


def run_job(
    store: Store,
    source: Source,
    specs: list[TableSpec],
    star: Star,
    steps: Collection[str] | None = None,
    as_of: str | None = None,
    dry_run: bool = False,
    run_id: str | None = None,
) -> JobResult:
    """Run the named steps. A failed extract ends the run, other failures do not; a dry run only logs.

    Intermediate tables of a step are removed when it ends, however it ends.
    """
    configure(store.spark)
    planned = plan_steps(steps)
    job = Job(store, source, specs, star, as_of or _now().strftime("%Y-%m-%d %H:%M:%S"), run_id or str(uuid.uuid4()))
    ok, statuses = True, {}
    for step in planned:
        start = _now()
        with run_folder(store.spark):
            right, error = (True, None) if dry_run else step.attempt(job)
        statuses[step.name] = "DRY_RUN" if dry_run else "FAILED" if error else "SUCCESS"
        _log(store, job.run_id, step.name, start, statuses[step.name], error)
        ok = ok and right
        if error and step.critical:
            break
    return JobResult(job.run_id, ok, statuses)


def reconcile(store: Store, source: Source, specs: list[TableSpec], run_id: str) -> bool:
    """Compare every raw table with its source, keep the result in the audit, tell whether all agree."""
    pairs = [Pair(spec.name, source(spec.name), store.find(RAW, spec.name)) for spec in specs]
    store.append("validation_results", report(pairs, run_id))
    return all_passed(store.audit("validation_results").where(F.col("run_id") == run_id)).first().all_passed


def _log(store: Store, run_id: str, step: str, start: datetime, status: str, error: str | None) -> None:
    row = [(run_id, step, start, _now(), status, error)]
    store.append("pipeline_runs", store.spark.createDataFrame(row, AUDIT_TABLES["pipeline_runs"]).coalesce(1))


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
