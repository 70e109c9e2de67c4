"""Evaluate rules: one row per rule with its failed and passed records."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection
from dataclasses import dataclass, replace

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    NumberFormatException,
    PythonException,
    SparkNoSuchElementException,
    SparkRuntimeException,
)
from pyspark.errors.exceptions.captured import convert_exception
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vouch.functions.checks import References, Unique, column_type
from vouch.functions.frames import union_all
from vouch.functions.nulls import column, nan_to_null
from vouch.functions.numeric import count_or_zero, pct
from vouch.plans.context import RunContext
from vouch.plans.rules import Rule, rule_frame
from vouch.sources.staging import settle

# What a faulty check raises; lost connections and internal errors end the run.
FAULTS = (AnalysisException, TypeError, ValueError, LookupError, AttributeError, ArithmeticError)

# What a check raises when it meets a value that it cannot work with.
DATA_FAULTS = (
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    NumberFormatException,
    PythonException,
    SparkNoSuchElementException,
    SparkRuntimeException,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RuleError:
    """A rule whose check could not be planned; it counts as passed."""

    rule_id: str
    message: str


def evaluate(
    tables: dict[str, DataFrame],
    rules: list[Rule],
    ctx: RunContext,
    errors: list[RuleError] | None = None,
    views: Collection[str] = (),
) -> DataFrame:
    """``dq_results``: every rule over its whole table.

    All row checks of a table share one scan and one aggregate. Uniqueness and reference
    checks work on the counts per key, which Spark combines before the shuffle, so a key
    held by a large share of the rows costs one row per task. Checks of the same key
    share those counts.

    Tables named in ``views`` are joins or other work that is dearer than a shuffle: their row
    checks are counted per key, in the pass that one of their keys needs anyway. A stored table
    is better scanned again, as its row checks then need no shuffle.
    """
    needed = {r.table_name for r in rules}
    needed |= {r.check.parent_table for r in rules if isinstance(r.check, References)}
    missing = sorted(needed - tables.keys())
    if missing:
        raise ValueError(f"no such tables: {', '.join(missing)}")
    if not rules:
        raise ValueError("no rules to evaluate")
    if len({r.rule_id for r in rules}) < len(rules):
        raise ValueError("rule ids must be unique")
    errors = [] if errors is None else errors
    tables = {name: nan_to_null(df) for name, df in tables.items()}
    numbered = {_tag(i): rule for i, rule in enumerate(rules)}
    parts = []
    for table_name in dict.fromkeys(r.table_name for r in rules):
        table_rules = {tag: r for tag, r in numbered.items() if r.table_name == table_name}
        parts += _table_parts(tables, tables[table_name], table_rules, ctx, errors, table_name in views)
    passed = F.col("total_records") - F.col("failed_records")
    registry = rule_frame(tables[rules[0].table_name].sparkSession, rules)
    tagged = registry.withColumn("tag", F.concat(F.lit(TAG), "rule_order"))
    return union_all(parts).join(tagged, "tag").select(
        F.lit(ctx.run_id).alias("run_id"),
        ctx.run_time_column().alias("run_time"),
        "table_name",
        "rule_id",
        "category",
        "severity",
        "description",
        "total_records",
        "failed_records",
        passed.alias("passed_records"),
        pct(passed, F.col("total_records"), 2).alias("pass_rate_pct"),
        F.when(F.col("failed_records") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


TAG = "rule_"


def isolated(
    evaluate: Callable[..., DataFrame],
    tables: dict[str, DataFrame],
    rules: list[Rule],
    ctx: RunContext,
    errors: list[RuleError],
    views: Collection[str] = (),
) -> DataFrame:
    """The results of ``evaluate``, worked out and kept, whatever values the data hold.

    A rule that fails on a value, such as a cast of text that is no number, counts as passed and is
    reported like one that cannot be planned. All rules are tried together first; only where
    that fails are they parted, by table and then by halves, until the failing ones stand
    alone: a bad value costs a few passes over its table. Lost executors, a full disk and other
    faults that are not the rule's end the run as ever.
    """
    found: list[RuleError] = []
    try:
        results = settle(evaluate(tables, rules, ctx, found, views))
    except (*DATA_FAULTS, Py4JJavaError) as error:
        fault = _data_fault(error)
        if fault is None:
            raise
        if len(rules) == 1:
            _report(rules[0], str(fault), errors)
            return settle(evaluate(tables, [replace(rules[0], check=lambda df, as_of: F.lit(False))], ctx, None, views))
        names = list(dict.fromkeys(r.table_name for r in rules))
        parts = [[r for r in rules if r.table_name == n] for n in names]
        if len(parts) == 1:
            parts = [rules[: len(rules) // 2], rules[len(rules) // 2 :]]
        return union_all([isolated(evaluate, tables, part, ctx, errors, views) for part in parts])
    errors.extend(found)
    return results


def _data_fault(error: Exception) -> Exception | None:
    """The error of a value that a check cannot work with, whether raised as it is or wrapped."""
    if isinstance(error, DATA_FAULTS):
        return error
    if not isinstance(error, Py4JJavaError):
        return None
    alone = map(convert_exception, _failures(error.java_exception))
    return next((e for e in alone if isinstance(e, DATA_FAULTS)), None)


def _failures(error: JavaObject) -> list[JavaObject]:
    """The failures that Spark raises as one error.

    With adaptive execution off, a failure in a broadcast comes as the cause of another error. With it
    on, stages that fail at once come as one error: the first as its cause, the others suppressed.
    What else has a cause, such as a file that cannot be read, is a failure of its own.
    """
    kind = error.getClass().getName()
    if kind == "java.util.concurrent.ExecutionException":
        return _failures(error.getCause())
    if kind == "org.apache.spark.SparkException" and error.getCondition() == "STAGE_MATERIALIZATION_MULTIPLE_FAILURES":
        return [f for e in (error.getCause(), *error.getSuppressed()) for f in _failures(e)]
    return [error]


def _tag(position: int) -> str:
    """The column that counts the failures of the rule at this position."""
    return f"{TAG}{position}"


def _table_parts(
    tables: dict[str, DataFrame],
    df: DataFrame,
    rules: dict[str, Rule],
    ctx: RunContext,
    errors: list[RuleError],
    once: bool = False,
) -> list[DataFrame]:
    """Frames of ``total_records, tag, failed_records`` that cover the rules of one table."""
    by_key: dict[tuple[str, ...], dict[str, Rule]] = {}
    row_rules: dict[str, Rule] = {}
    unchecked: list[str] = []
    for tag, rule in rules.items():
        if not isinstance(rule.check, (Unique, References)):
            row_rules[tag] = rule
            continue
        keys = rule.check.columns if isinstance(rule.check, Unique) else (rule.check.column,)
        absent = [k for k in keys if column_type(df, k) is None]
        if not absent:
            by_key.setdefault(keys, {})[tag] = rule
            continue
        unchecked.append(tag)
        # a reference from a column that is not there holds, any other check is at fault
        if isinstance(rule.check, Unique):
            _report(rule, f"no column {', '.join(absent)}", errors)
    violations = _violations(df, row_rules, ctx, errors)
    key_parts = []
    for keys, group in by_key.items():
        try:
            key_parts.append(_key_part(tables, df, keys, group, violations if once else {}))
            if once:
                violations = {}
        except FAULTS:
            for tag, rule in group.items():
                try:
                    key_parts.append(_key_part(tables, df, keys, {tag: rule}))
                except FAULTS as error:  # such as a key of another type than its parent
                    _report(rule, str(error), errors)
                    unchecked.append(tag)
    violations = {**violations, **{tag: F.lit(False) for tag in unchecked}}
    return ([_row_part(df, violations)] if violations else []) + key_parts


def _violations(
    df: DataFrame, rules: dict[str, Rule], ctx: RunContext, errors: list[RuleError]
) -> dict[str, Column]:
    """The violation Column of every row rule; false for a rule that cannot be planned."""
    as_of = ctx.as_of_column()
    planned = {}
    for tag, rule in rules.items():
        try:
            planned[tag] = rule.check(df, as_of)
        except Py4JError:  # no fault of the check
            raise
        except Exception as error:  # a faulty check must not stop the run
            _report(rule, str(error), errors)
            planned[tag] = F.lit(False)
    try:
        _check_boolean(df, list(planned.values()))
    except FAULTS:
        for tag in planned:
            try:
                _check_boolean(df, [planned[tag]])
            except FAULTS as error:
                _report(rules[tag], str(error), errors)
                planned[tag] = F.lit(False)
    return planned


def _check_boolean(df: DataFrame, violations: list[Column]) -> None:
    """Raise unless Spark resolves all violations over ``df`` as booleans."""
    for field in df.select(*violations).schema:
        if not isinstance(field.dataType, T.BooleanType):
            raise TypeError(f"check gives {field.dataType.simpleString()}, not boolean")


def _report(rule: Rule, message: str, errors: list[RuleError]) -> None:
    message = message.split("\n")[0]  # Spark adds the whole plan
    log.error("rule %s not checked, counted as passed: %s", rule.rule_id, message)
    errors.append(RuleError(rule.rule_id, message))


def _row_part(df: DataFrame, violations: dict[str, Column]) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(violation).alias(tag) for tag, violation in violations.items()],
    )
    return _row_per_rule(counts, violations)


def _key_part(
    tables: dict[str, DataFrame],
    df: DataFrame,
    keys: tuple[str, ...],
    rules: dict[str, Rule],
    violations: dict[str, Column] | None = None,
) -> DataFrame:
    """The rules of a key, and the row checks of ``violations``, from one pass that counts per key."""
    violations = violations or {}
    names = [f"key_{i}" for i in range(len(keys))]
    counts = df.groupBy(*[column(k).alias(n) for k, n in zip(keys, names)]).agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(violation).alias(tag) for tag, violation in violations.items()],
    )
    broken = {}
    for tag, rule in rules.items():
        if isinstance(rule.check, Unique):
            broken[tag] = F.col("records") > 1
        else:
            known = f"known_{tag}"
            counts = _flag_known(counts, tables, rule.check, column_type(df, keys[0]), known)
            broken[tag] = F.col(known).isNull()
    totals = counts.agg(
        count_or_zero(F.sum("records")).alias("total_records"),
        *[count_or_zero(F.sum(F.when(b, F.col("records")))).alias(tag) for tag, b in broken.items()],
        *[count_or_zero(F.sum(tag)).alias(tag) for tag in violations],
    )
    return _row_per_rule(totals, {**rules, **violations})


def _flag_known(
    counts: DataFrame,
    tables: dict[str, DataFrame],
    check: References,
    key_type: T.DataType,
    flag: str,
) -> DataFrame:
    """``counts`` with ``flag`` true where the parent has the key, NULL where it has not."""
    parent = tables[check.parent_table]
    parent_key = column(check.parent_key)
    key = F.col("key_0")
    if isinstance(key_type, T.StringType) != isinstance(
        column_type(parent, check.parent_key), T.StringType
    ):
        key, parent_key = key.cast("string"), parent_key.cast("string")
    known = (
        parent.select(parent_key.alias("parent_key"))
        .where(F.col("parent_key").isNotNull())
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    return counts.join(known, key == F.col("parent_key"), "left").drop("parent_key")


def _row_per_rule(counts: DataFrame, tags: dict) -> DataFrame:
    return counts.unpivot("total_records", list(tags), "tag", "failed_records")
