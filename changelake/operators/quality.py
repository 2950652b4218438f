"""Rule-based validation: annotate every row, split into valid and quarantine.

A rule is a named boolean -- SQL text (as in a ``WHERE`` clause) or a
``Column``. A rule passes only when it is TRUE: a NULL result counts as a
failure, so every input row ends up in exactly one of the two outputs and the
failure list names every rule that did not pass.

All rule expressions are added in one ``select``; both outputs are filters of
the same annotated frame, so a caller that persists it once pays for the
upstream plan once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS_COL = "_validation_errors"
ERROR_SEPARATOR = ", "

RuleSet = Mapping[str, "str | Column"]


def rule_column(rule: str | Column) -> Column:
    """Rule text or column -> boolean column where NULL counts as failed."""
    expr = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(expr, F.lit(False))


def failures_column(rules: RuleSet) -> Column:
    """Comma-separated names of the failed rules (rule order kept); NULL when
    every rule passed."""
    names = [F.when(~rule_column(r), F.lit(name)) for name, r in rules.items()]
    return F.nullif(F.concat_ws(ERROR_SEPARATOR, *names), F.lit(""))


def annotate(df: DataFrame, rules: RuleSet) -> DataFrame:
    """All input columns plus ``_validation_errors`` (NULL = valid row)."""
    if not rules:
        return df.withColumn(ERRORS_COL, F.lit(None).cast("string"))
    return df.select("*", failures_column(rules).alias(ERRORS_COL))


def valid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col(ERRORS_COL).isNull()).drop(ERRORS_COL)


def invalid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col(ERRORS_COL).isNotNull())


def split(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined). With no rules the input comes back unchanged and
    the quarantine side is empty."""
    if not rules:
        return df, df.limit(0).withColumn(ERRORS_COL, F.lit(None).cast("string"))
    annotated = annotate(df, rules)
    return valid_rows(annotated), invalid_rows(annotated)


def failure_counts(quarantined: DataFrame) -> DataFrame:
    """Rows failing each rule, read back from the error text."""
    return (quarantined
            .select(F.explode(F.split(F.col(ERRORS_COL), ERROR_SEPARATOR)).alias("rule_name"))
            .groupBy("rule_name")
            .agg(F.count(F.lit(1)).alias("failed_rows")))


def replay(quarantined: DataFrame, rules: RuleSet) -> tuple[DataFrame, DataFrame]:
    """Re-check quarantined rows against (fixed) rules without a full run."""
    return split(quarantined.drop(ERRORS_COL), rules)
