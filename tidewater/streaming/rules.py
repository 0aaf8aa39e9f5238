"""Patterns that change while a stream runs.

Control rows name the rule in force from their time on, for all keys; a switch discards
partial matches, as on tables (``operators.pattern.rules``). ``RuleMatcher`` keeps, beside
the checkpoint and one folder per batch, a log of the rules with their epochs (the
snapshot every task of a batch works with), the events that wait for the watermark, and the
events that may still take part in a match, with the epoch they were given. All that a
batch writes follows from the folders of the batch before and its own rows, so a
retried batch overwrites its folders with the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence as Seq
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import sequence as S
from tidewater.operators.pattern.rules import match_epochs, with_epoch
from tidewater.operators.pattern.spec import Pattern, PatternError
from tidewater.session import work_dir


MARK = T.StructType([T.StructField("mark", T.TimestampType()), T.StructField("epoch", T.LongType()), T.StructField("rule", T.StringType())])


class RuleMatcher:
    """foreachBatch sink that writes the matches of whichever rule is in force.

    ``rule`` is NULL on data rows. On a control row it is the name of one of ``rules`` or
    the JSON text of a pattern, which no restart is needed for. Every pattern needs
    ``within``, which bounds the events kept. Rows at or before the watermark (greatest
    time less ``delay``) of the batch before are late and dropped, control rows too.
    """

    def __init__(
        self, spark: SparkSession, rule: Column, by: Seq[str], ts: str, tie: Seq[str], payload: Seq[str], delay: timedelta,
        rules: dict[str, Pattern | str] | None = None, first_rule: str | None = None, path: str | None = None, width: timedelta | None = None,
    ) -> None:
        self.spark, self.rule, self.by, self.ts, self.tie, self.payload = spark, rule.cast("string"), list(by), ts, list(tie), list(payload)
        self.delay, self.first_rule, self.width = delay, first_rule, width
        self.patterns = {k: self._checked(p) for k, p in (rules or {}).items()}
        self.path = path or work_dir(spark, "rules")

    @staticmethod
    def _checked(p: Pattern | str) -> Pattern:
        p = (Pattern.from_json(p) if isinstance(p, str) else p).check()
        if p.within_ is None:
            raise PatternError("a rule on a stream needs within(), which bounds the events it keeps")
        if p.skip.kind != "none":
            raise PatternError("rules on a stream report all matches")
        return p

    def pattern(self, rule: str) -> Pattern:
        """The pattern of a rule's name or text, parsed once."""
        if rule not in self.patterns:
            self.patterns[rule] = self._checked(rule)
        return self.patterns[rule]

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/batch={batch_id}"

    def _put(self, df: DataFrame, kind: str, batch_id: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._folder(kind, batch_id))
        return self.spark.read.schema(df.schema).parquet(self._folder(kind, batch_id))

    def _before(self, batch_id: int) -> tuple:
        """Watermark, last epoch and rule in force after the batch before."""
        if batch_id == 0:
            return None, 0, self.first_rule
        return tuple(self.spark.read.schema(MARK).parquet(self._folder("marks", batch_id - 1)).first())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        old, epoch, rule = self._before(batch_id)
        new = batch if old is None else batch.where(F.col(self.ts) > F.lit(old))
        if batch_id:
            new = new.unionByName(self.spark.read.schema(batch.schema).parquet(self._folder("waiting", batch_id - 1)))
        top = new.agg(F.max(self.ts)).first()[0]
        mark = old if top is None else max(top - self.delay, old) if old is not None else top - self.delay
        passed = F.lit(False) if mark is None else F.col(self.ts) <= F.lit(mark)
        self._put(new.where(~F.coalesce(passed, F.lit(False))), "waiting", batch_id)
        ready = new.where(passed)

        # Control rows are numbered on from the last epoch.
        control = ready.withColumn("__rule", self.rule).where("__rule IS NOT NULL")
        numbered = S.unchunked(S.positions(control, S.sequence(control, (), self.ts, self.tie, self.width), "__n"))
        log = self._put(numbered.select((F.col("__n") + epoch).cast("bigint").alias("epoch"), F.col(self.ts).alias("since"), F.col("__rule").alias("rule")), "log", batch_id)
        events = with_epoch(ready, self.rule, self.ts, self.tie, rule, self.width).withColumn("epoch", F.col("epoch") + epoch)
        events = self._put(events.where("rule_id IS NOT NULL"), "events", batch_id)
        if batch_id:
            events = events.unionByName(self.spark.read.schema(events.schema).parquet(self._folder("kept", batch_id - 1)))
        last = log.agg(F.max("epoch").alias("epoch"), F.max_by("rule", "epoch").alias("rule")).first()
        if last.epoch is not None:
            epoch, rule = last.epoch, last.rule

        # One row per rule that any event is under.
        used = [r.rule_id for r in events.select("rule_id").distinct().collect()]
        parts = [match_epochs(events.where(F.col("rule_id") == r), r, self.pattern(r), self.by, self.ts, self.tie, self.payload, self.width) for r in used]
        if parts:
            found = reduce(DataFrame.unionByName, parts)
            self._put(found if old is None else found.where(F.col("end_ts") > F.lit(old)), "matches", batch_id)
        reach = max((self.pattern(r).within_ for r in used), default=timedelta())
        self._put(events if mark is None else events.where(F.col(self.ts) > F.lit(mark - reach)), "kept", batch_id)
        self._put(self.spark.createDataFrame([(mark, epoch, rule)], MARK).coalesce(1), "marks", batch_id)

    def matches(self) -> DataFrame:
        """Matches of all batches: key, ``rule_id``, ``epoch``, ``start_ts``, ``end_ts`` and ``events`` (step, event)."""
        return self.spark.read.option("basePath", f"{self.path}/matches").parquet(f"{self.path}/matches").drop("batch")

    def rules_at(self, batch_id: int | None = None) -> DataFrame:
        """``epoch``, ``since`` and ``rule`` of all control rows that had passed the watermark after a batch (the last one if not given)."""
        log = self.spark.read.option("basePath", f"{self.path}/log").parquet(f"{self.path}/log")
        return (log if batch_id is None else log.where(F.col("batch") <= batch_id)).drop("batch")
