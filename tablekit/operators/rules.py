"""Typed-column rules: one narrow pass that casts, judges and explains each row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tablekit.functions.casts import cast_is_defined, tolerant_cast
from tablekit.functions.columns import quoted

ERROR_COLUMN = "data_quality_error"
REJECTED = "__rejected"
_RULE = "__failed_rule"
_TYPED = "__typed_{}"


@dataclass(frozen=True)
class Rule:
    """``column`` must hold a value of ``type``; a null also breaks the rule
    unless ``nullable``."""

    column: str
    type: T.DataType
    message: str
    nullable: bool = False


class Split(NamedTuple):
    """Rows that passed, rows that did not (None if nothing was checked), and the
    columns whose rule was skipped because the frame lacks them."""

    valid: DataFrame
    rejected: DataFrame | None
    skipped: tuple[str, ...] = ()


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], watch: Observation | None = None
) -> Split:
    """Split ``df`` by ``rules``; a row is rejected by the first rule it breaks.

    Both sides are filters over one projection, without shuffle or cache. With
    ``watch``, writing the valid side also reports ``rejected``, the number of
    rows on the other side.
    """
    active = [rule for rule in rules if rule.column in df.columns]
    skipped = tuple(rule.column for rule in rules if rule.column not in df.columns)
    if not active:
        return Split(df, None, skipped)

    judged = _judge(df, active)
    broken = F.count(F.col(_RULE)).alias("rejected")
    # A metric keeps the filter on the verdict above the judging: pushed below, it would
    # judge each row it keeps a second time.
    return Split(
        _valid_side(judged.observe(watch or _unwatched(), broken), df.columns, active),
        _rejected_side(judged.observe(_unwatched(), broken), df.columns, active),
        skipped,
    )


def judge_rows(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame | None, tuple[str, ...]]:
    """Both sides of ``df`` in one frame, for writers that take them apart, and the
    columns whose rule was skipped; no frame if nothing is checked.

    A row that passed has its typed columns, a rejected one only ``REJECTED``: a struct
    with the columns of the error table, null on the other side.
    """
    active = [rule for rule in rules if rule.column in df.columns]
    skipped = tuple(rule.column for rule in rules if rule.column not in df.columns)
    if not active:
        return None, skipped
    if REJECTED in df.columns:
        raise ValueError(f"reserved column names in the input: {[REJECTED]}")
    judged = _judge(df, active)
    passed = F.col(_RULE).isNull()
    valid = [F.when(passed, c).alias(name) for name, c in _valid_columns(df.columns, active)]
    rejected = F.when(~passed, F.struct(*_rejected_columns(judged, df.columns, active))).alias(REJECTED)
    return judged.select(*valid, rejected), skipped


def _unwatched() -> Observation:
    return Observation(f"rules-{uuid4().hex}")


def _judge(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The input, one typed column per rule, and the number of the first broken rule."""
    if len({rule.column for rule in rules}) < len(rules):
        raise ValueError("a column may have one rule only")
    reserved = {_RULE, *(_TYPED.format(i) for i in range(len(rules)))}
    clashes = reserved.intersection(df.columns)
    if clashes:
        raise ValueError(f"reserved column names in the input: {sorted(clashes)}")

    typed = df.select("*", *[_typed(df, r).alias(_TYPED.format(i)) for i, r in enumerate(rules)])
    broken = [_is_broken(rule, F.col(_TYPED.format(i))) for i, rule in enumerate(rules)]
    return typed.withColumn(_RULE, _first_true(broken))


def _typed(df: DataFrame, rule: Rule) -> Column:
    if not cast_is_defined(df, rule.column, rule.type):
        return F.lit(None).cast(rule.type)
    return tolerant_cast(quoted(rule.column), df.schema[rule.column].dataType, rule.type)


def _is_broken(rule: Rule, typed: Column) -> Column:
    if rule.nullable:
        return typed.isNull() & quoted(rule.column).isNotNull()
    return typed.isNull()


def _first_true(conditions: list[Column]) -> Column:
    return F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)])


def _valid_side(judged: DataFrame, columns: list[str], rules: list[Rule]) -> DataFrame:
    return judged.where(F.col(_RULE).isNull()).select(*[c.alias(name) for name, c in _valid_columns(columns, rules)])


def _valid_columns(columns: list[str], rules: list[Rule]) -> list[tuple[str, Column]]:
    typed = {rule.column: F.col(_TYPED.format(i)) for i, rule in enumerate(rules)}
    return [(c, typed.get(c, quoted(c))) for c in columns]


def _rejected_side(judged: DataFrame, columns: list[str], rules: list[Rule]) -> DataFrame:
    return judged.where(F.col(_RULE).isNotNull()).select(*_rejected_columns(judged, columns, rules))


def _rejected_columns(judged: DataFrame, columns: list[str], rules: list[Rule]) -> list[Column]:
    """Rule columns become text: the cast value once its rule passed, else the raw one."""
    as_text = {
        rule.column: F.when(F.col(_RULE) > i, F.col(_TYPED.format(i)).cast("string"))
        .otherwise(_raw_text(judged, rule.column))
        for i, rule in enumerate(rules)
    }
    message = reduce(
        lambda chain, item: chain.when(F.col(_RULE) == item[0], F.lit(item[1].message)),
        list(enumerate(rules))[1:],
        F.when(F.col(_RULE) == 0, F.lit(rules[0].message)),
    )
    kept = [as_text.get(c, quoted(c)).alias(c) for c in columns if c != ERROR_COLUMN]
    return [*kept, message.alias(ERROR_COLUMN)]


def _raw_text(df: DataFrame, name: str) -> Column:
    if cast_is_defined(df, name, T.StringType()):
        return quoted(name).cast("string")
    return F.to_json(quoted(name))
