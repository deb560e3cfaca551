"""Data-quality checks: reports, gates, violating rows and samples.

Three kinds of check. A row check fails rows where its predicate is true; an unknown predicate passes. A group
check fails key groups by their row count. A frame check fails every row of a given frame.

A report costs one aggregate for all row checks, one aggregate per chain of nested group keys, and one count
per frame check. Counts combine map-side, so a huge key group never reaches one task as rows. Samples of all failing checks
of a suite are one job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CRITICAL, WARNING = "critical", "warning"


@dataclass(frozen=True)
class RowCheck:
    name: str
    fails: Column
    severity: str = CRITICAL


@dataclass(frozen=True)
class GroupCheck:
    name: str
    keys: tuple[str, ...]
    fails: Callable[[Column], Column]
    severity: str = CRITICAL
    ignore_null_keys: bool = False

    def failing(self, count: str) -> Column:
        failing = self.fails(F.col(count))
        if self.ignore_null_keys:
            for key in self.keys:
                failing = failing & F.col(key).isNotNull()
        return failing


@dataclass(frozen=True)
class FrameCheck:
    name: str
    violations: DataFrame
    severity: str = CRITICAL


Check = RowCheck | GroupCheck | FrameCheck


def repeated(name: str, *keys: str, ignore_null_keys: bool = False) -> GroupCheck:
    """Groups with more than one row."""
    return GroupCheck(name, keys, lambda n: n > 1, ignore_null_keys=ignore_null_keys)


# Counts are named by position while they are computed, so that suites may share check names.
Numbered = tuple[str, Check]


def _row_counts(frame: DataFrame, checks: Sequence[Numbered]) -> DataFrame:
    return frame.agg(*[F.count_if(check.fails).alias(name) for name, check in checks])


def key_chains(checks: Sequence[Numbered]) -> list[list[tuple[str, ...]]]:
    """Distinct key sets, gathered into chains that each go from finer keys to a subset of them."""
    chains: list[list[tuple[str, ...]]] = []
    for keys in sorted({check.keys for _, check in checks}, key=len, reverse=True):
        for chain in chains:
            if set(keys) < set(chain[-1]):
                chain.append(keys)
                break
        else:
            chains.append([keys])
    return chains


def chain_counts(
    groups: DataFrame, chain: Sequence[tuple[str, ...]], checks: Sequence[Numbered]
) -> DataFrame:
    """Failing groups per check, from the finest groups with their row count ``_n``. Coarser keys are counted from them."""
    done: list[str] = []
    for keys, coarser in zip(chain, [*chain[1:], None]):
        here = [(name, check) for name, check in checks if check.keys == keys]
        failing = [F.count_if(check.failing("_n")).alias(name) for name, check in here]
        failing += [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in done]
        if coarser is None:
            return groups.agg(*failing)
        groups = groups.groupBy(*coarser).agg(F.sum("_n").alias("_n"), *failing)
        done += [name for name, _ in here]
    raise ValueError("no group keys")


def report_lines(counts: DataFrame, checks: Sequence[Numbered]) -> DataFrame:
    """One row of counts to one row per check."""
    entries = [
        F.struct(
            F.lit(int(name.removeprefix("c"))).alias("position"),
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            F.col(name).cast("bigint").alias("invalid_count"),
        )
        for name, check in checks
    ]
    return counts.select(F.inline(F.array(*entries)))


def positioned_counts(frame: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows (position, check_name, severity, invalid_count), one per check in the order given, from 0."""
    numbered = [(f"c{i}", check) for i, check in enumerate(checks)]
    parts = []
    rows = [(name, check) for name, check in numbered if isinstance(check, RowCheck)]
    if rows:
        parts.append(report_lines(_row_counts(frame, rows), rows))
    grouped = [(name, check) for name, check in numbered if isinstance(check, GroupCheck)]
    for chain in key_chains(grouped):
        members = [(name, check) for name, check in grouped if check.keys in chain]
        groups = frame.groupBy(*chain[0]).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(report_lines(chain_counts(groups, chain, members), members))
    for name, check in numbered:
        if isinstance(check, FrameCheck):
            counted = check.violations.agg(F.count(F.lit(1)).alias(name))
            parts.append(report_lines(counted, [(name, check)]))
    return reduce(DataFrame.unionByName, parts)


def count_failures(frame: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows (check_name, severity, invalid_count), one per check."""
    return positioned_counts(frame, checks).drop("position")


def violations(frame: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Every failing row or group once per check it fails, with ``check_name``.

    Rows carry their own columns, groups their keys and ``count``; the other columns are null.
    """
    parts = []
    rows = [check for check in checks if isinstance(check, RowCheck)]
    if rows:
        names = F.array_compact(F.array(*[F.when(check.fails, F.lit(check.name)) for check in rows]))
        parts.append(frame.withColumn("check_name", F.explode(names)))
    for check in checks:
        if isinstance(check, GroupCheck):
            groups = frame.groupBy(*check.keys).count().filter(check.failing("count"))
            parts.append(groups.withColumn("check_name", F.lit(check.name)))
        elif isinstance(check, FrameCheck):
            parts.append(check.violations.withColumn("check_name", F.lit(check.name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def failing_frame(frame: DataFrame, check: Check) -> DataFrame:
    """What one check fails: rows, or groups with their ``count``."""
    if isinstance(check, RowCheck):
        return frame.filter(check.fails)
    if isinstance(check, GroupCheck):
        return frame.groupBy(*check.keys).count().filter(check.failing("count"))
    return check.violations


def samples(frame: DataFrame, checks: Sequence[Check], limit: int, order: Column | None = None) -> DataFrame:
    """Up to ``limit`` violations of each check, for all checks in one job; ``rank`` counts them from 1.

    Which ones is determined: the first by ``order``, or else by a digest of the whole violation. Spark keeps no more than
    ``limit`` rows a check and task before it shuffles them.
    """
    failing = violations(frame, checks)
    columns = [name for name in failing.columns if name != "check_name"]
    digest = F.md5(F.to_json(F.struct(*[F.col(name) for name in columns])))
    keys = [digest] if order is None else [order, digest]
    rank = F.row_number().over(Window.partitionBy("check_name").orderBy(*keys))
    return failing.withColumn("rank", rank).where(F.col("rank") <= limit)


def _sample_columns(frame: DataFrame, check: Check) -> list[str]:
    if isinstance(check, RowCheck):
        return frame.columns
    return [*check.keys, "count"] if isinstance(check, GroupCheck) else check.violations.columns


def _sampled(frame: DataFrame, wanted: dict[int, Check], limit: int) -> dict[int, list[dict]]:
    """Records of failing checks by their position; suites may share the names of checks."""
    if not wanted:
        return {}
    numbered = [replace(check, name=str(position)) for position, check in wanted.items()]
    found: dict[int, list[dict]] = {position: [] for position in wanted}
    for row in sorted(samples(frame, numbered, limit).collect(), key=lambda row: row["rank"]):
        position = int(row["check_name"])
        found[position].append({name: row[name] for name in _sample_columns(frame, wanted[position])})
    return found


@dataclass(frozen=True)
class CheckResult:
    check_name: str
    severity: str
    invalid_count: int
    sample_records: list[dict] = field(default_factory=list)


@dataclass(frozen=True)
class Report:
    """Check results in suite order, with the row count of the table."""

    suite: str
    row_count: int
    checks: list[CheckResult]

    def failing(self, severity: str | None = None) -> list[CheckResult]:
        return [c for c in self.checks if c.invalid_count > 0 and severity in (None, c.severity)]

    @property
    def critical_failures(self) -> int:
        return len(self.failing(CRITICAL))

    @property
    def warning_failures(self) -> int:
        return len(self.failing(WARNING))


class QualityError(ValueError):
    """A gate found critical failures."""

    def __init__(self, report: Report):
        self.report = report
        lines = [f"{c.check_name}: {c.invalid_count} invalid rows or groups" for c in report.failing(CRITICAL)]
        super().__init__("\n- ".join([f"{report.suite} failed its quality checks:", *lines]))


@dataclass(frozen=True)
class Suite:
    """Named checks, whether they gate, and how many records to sample per failing check."""

    name: str
    checks: Sequence[Check]
    gate: bool = True
    quarantine: bool = False
    sample_limit: int = 0


def build_reports(
    frame: DataFrame,
    suites: Sequence[Suite],
    counting: Callable[[DataFrame, Sequence[Check]], DataFrame] = positioned_counts,
) -> list[Report]:
    """Run several suites over one table together: one scan for all their row checks, one per chain of keys.

    Another ``counting`` may know counts of earlier runs; its rows are those of ``positioned_counts``.
    """
    checks: list[Check] = [RowCheck("rows", F.lit(True)), *[check for suite in suites for check in suite.checks]]
    counted = {row["position"]: row["invalid_count"] for row in counting(frame, checks).collect()}
    reports, position = [], 1
    for suite in suites:
        placed = dict(enumerate(suite.checks, position))
        position += len(placed)
        failing = {at: check for at, check in placed.items() if counted[at]} if suite.sample_limit else {}
        sampled = _sampled(frame, failing, suite.sample_limit)
        results = [
            CheckResult(check.name, check.severity, counted[at], sampled.get(at, [])) for at, check in placed.items()
        ]
        reports.append(Report(suite.name, counted[0], results))
    return reports


def build_report(name: str, frame: DataFrame, checks: Sequence[Check], sample_limit: int = 0) -> Report:
    """Run one suite. With ``sample_limit``, each failing check also brings that many failing records."""
    return build_reports(frame, [Suite(name, checks, sample_limit=sample_limit)])[0]


def require_no_critical(report: Report) -> Report:
    """Raise if any critical check failed."""
    if report.critical_failures:
        raise QualityError(report)
    return report
