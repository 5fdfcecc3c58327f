"""Row constraints of the fraud table: NOT NULL on the six business columns and
maximum text lengths.  Instead of failing a whole append on one bad row (what
a database does), rows are split into valid rows and a quarantine carrying the
list of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tripwire.config import (MAX_LEN_FRAUD_REASON, MAX_LEN_LOCATION, MAX_LEN_MERCHANT_CATEGORY,
                             MAX_LEN_USER_ID)
from tripwire.schema import FRAUD_COLUMNS

MAX_LENGTHS = {
    "user_id": MAX_LEN_USER_ID,
    "merchant_category": MAX_LEN_MERCHANT_CATEGORY,
    "location": MAX_LEN_LOCATION,
    "fraud_reason": MAX_LEN_FRAUD_REASON,
}


def rules(df: DataFrame, not_null: list[str] | None = None) -> dict[str, Column]:
    """Message -> whether a row of ``df`` breaks that rule."""
    not_null = not_null if not_null is not None else FRAUD_COLUMNS
    out = {f"{c} IS NULL": F.col(c).isNull() for c in not_null}
    for c, n in MAX_LENGTHS.items():
        if c in df.columns:
            out[f"{c} LONGER THAN {n}"] = F.char_length(F.col(c)) > n
    return out


def constraint_violations(df: DataFrame, not_null: list[str] | None = None) -> DataFrame:
    """Adds ``violations`` (array of messages, empty when the row is valid)."""
    checks = [F.when(broken, F.lit(message)) for message, broken in rules(df, not_null).items()]
    violations = F.filter(F.array(*checks), lambda v: v.isNotNull())
    return df.withColumn("violations", violations)


def observed(df: DataFrame, name: str | Observation = "quality", not_null: list[str] | None = None) -> DataFrame:
    """``df`` with its rule figures counted on the way, without another pass: rows,
    bad rows and rows per broken rule.  In a stream (``name`` a text) every
    micro-batch reports its figures to ``QualityListener``; a batch query gives
    them through an ``Observation``."""
    broken = rules(df, not_null)
    some = F.lit(False)
    for rule in broken.values():
        some = some | F.coalesce(rule, F.lit(False))
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(some).alias("bad_rows"),
                      *[F.count_if(rule).alias(message) for message, rule in broken.items()])


class QualityListener(StreamingQueryListener):
    """Sums the figures of ``observed`` streams per query id, batch by batch.

    A batch that is repeated after a failure replaces its figures.  ``alert`` is
    called with (query id, batch id, share of bad rows) when a batch's share
    exceeds ``most_bad``.  Only the newest ``kept`` batches of a query stay single;
    older ones are added to one row."""

    def __init__(self, name: str = "quality", most_bad: float = 1.0, alert=None, kept: int = 100):
        self.name, self.most_bad, self.alert, self.kept = name, most_bad, alert, kept
        self._batches: dict[str, dict[int, dict[str, int]]] = {}
        self._older: dict[str, dict[str, int]] = {}

    def record(self, query: str, batch: int, figures: dict[str, int]) -> None:
        batches = self._batches.setdefault(query, {})
        batches[batch] = figures
        if len(batches) > self.kept:
            self._older[query] = _added(self._older.get(query, {}), batches.pop(min(batches)))
        share = figures["bad_rows"] / figures["rows"] if figures["rows"] else 0.0
        if self.alert is not None and share > self.most_bad:
            self.alert(query, batch, share)

    def totals(self, query: str) -> dict[str, int]:
        out = dict(self._older.get(query, {}))
        for figures in self._batches.get(query, {}).values():
            out = _added(out, figures)
        return out

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        figures = event.progress.observedMetrics.get(self.name)
        if figures is not None:
            self.record(str(event.progress.id), event.progress.batchId, figures.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _added(a: dict[str, int], b: dict[str, int]) -> dict[str, int]:
    return {k: a.get(k, 0) + b.get(k, 0) for k in {**a, **b}}


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = constraint_violations(df)
    ok = F.size("violations") == 0
    return checked.filter(ok).drop("violations"), checked.filter(~ok)
