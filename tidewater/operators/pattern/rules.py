"""Patterns that change while events arrive.

Control rows in the event stream name the rule in force from there on, for all
keys. A switch discards partial matches, so events are matched within
(key, epoch), where the epoch is the control row last seen.
"""

from __future__ import annotations

from collections.abc import Sequence as Seq
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import sequence as S
from tidewater.operators.pattern.api import find
from tidewater.operators.pattern.graph import build
from tidewater.operators.pattern.spec import Pattern


def with_epoch(
    df: DataFrame, rule: Column, ts: str, tie: Seq[str], first_rule: str | None = None, width: timedelta | None = None,
) -> DataFrame:
    """Data rows with ``rule_id`` in force and its ``epoch``.

    ``rule`` is the rule named by a control row and NULL on data rows. Control
    rows are dropped. The epoch is 0 before the first control row.
    """
    d = df.withColumn("__rule", rule.cast("string"))
    seq = S.sequence(d, (), ts, tie, width)
    # Control rows are numbered among themselves; the events then take the
    # number and rule of the last one in a single pass.
    numbered = S.unchunked(S.positions(d.where(F.col("__rule").isNotNull()), seq, "__n"))
    control = F.struct(F.col("__n"), F.col("__rule"))
    numbered = numbered.withColumn("__control", control).drop("__n")
    events = d.where(F.col("__rule").isNull()).withColumn(
        "__control", F.lit(None).cast(numbered.schema["__control"].dataType))
    out = S.carry(events.unionByName(numbered), seq, {"__seen": F.col("__control")}, inclusive=True)
    out = S.unchunked(out.withColumns({
        "epoch": F.coalesce(F.col("__seen")["__n"], F.lit(0)).cast("bigint"),
        "rule_id": F.coalesce(F.col("__seen")["__rule"], F.lit(first_rule))})).drop("__control", "__seen")
    return out.where(F.col("__rule").isNull()).drop("__rule")


def match_rules(
    df: DataFrame, rules: dict[str, Pattern | str], rule: Column, by: Seq[str], ts: str, tie: Seq[str] = (),
    payload: Seq[str] | None = None, first_rule: str | None = None, width: timedelta | None = None,
) -> DataFrame:
    """Matches of whichever rule is in force: key, ``rule_id``, ``epoch``,
    ``start_ts``, ``end_ts`` and ``events`` (step, event) in order.

    A rule is a pattern or its JSON text, parsed once here.
    """
    payload = list(payload) if payload is not None else [c for c in df.columns if c not in by]
    data = with_epoch(df, rule, ts, tie, first_rule)
    # Fitted on the events themselves: an epoch only makes groups smaller.
    width = S.sequence(df, by, ts, tie, width).width
    parts = []
    for rule_id, p in rules.items():
        p = (Pattern.from_json(p) if isinstance(p, str) else p).check()
        parts.append(match_epochs(data.where(F.col("rule_id") == rule_id), rule_id, p, by, ts, tie, payload, width))
    return reduce(DataFrame.unionByName, parts)


def match_epochs(
    data: DataFrame, rule_id: str, pattern: Pattern, by: Seq[str], ts: str, tie: Seq[str], payload: Seq[str], width: timedelta | None,
) -> DataFrame:
    """Matches of one rule within (key, ``epoch``)."""
    keys = [*by, "epoch"]
    g = build(pattern)
    found = find(data, pattern, g, keys, ts, tie, payload, width, False)
    names = F.array(*[F.lit(s.name) for s in g.slots])
    events = F.transform("items", lambda x: F.struct(F.element_at(names, x["slot"] + 1).alias("step"), x["e"].alias("event")))
    return found.select(*[F.col(S.KEY)[k].alias(k) for k in keys], F.lit(rule_id).alias("rule_id"), "start_ts", "end_ts", events.alias("events"))
