"""Keyed state, batch forms: T1 merge-and-forward, T2 two inputs, T5 TTL, P11.

The device twin keeps, per key, the latest DESIRED and the latest REPORTED
state and forwards the merged record after every input.  Batch replay:

* changelog = two running last-value scans per key in arrival order (one per
  state type), skew-safe;
* latest = ``max_by`` per key and type (hash aggregate, map-side combine);
* TTL = a filter with an explicit ``as_of`` instead of the wall clock.

The streaming forms are :class:`streamtab.streaming.exact.TwinCarry` (state between
micro-batches) and :class:`streamtab.streaming.processors.TwinProcessor` (timers).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import whole_days_between
from .scan import Agg, ScanConfig, running
from .stateless import emit_with_derived

# Fixed values of the reference's turbine flow
DESIRED, REPORTED = "DESIRED", "REPORTED"
POWER_ON, POWER_OFF = "ON", "OFF"
HIGH_WIND_MPH = 65.0
TTL_DAYS = 7


def twin_inputs(reported: DataFrame, desired: DataFrame, wind: str = "wind_speed_mph",
                power: str = "power", type_col: str = "type",
                threshold: float = HIGH_WIND_MPH) -> DataFrame:
    """The two sources feeding one stateful node.  Reported rows pass the
    high-wind rule first (P11): wind above the threshold with power ON also
    emits a derived DESIRED row with power OFF, ordered right after its parent.
    A null wind speed never triggers the rule.

    A record that carries its own ``type_col`` keeps it, whatever input it came
    by (an unset or foreign type changes no state); inputs without that column
    get the type of their side."""
    def typed(df: DataFrame, side: str) -> DataFrame:
        return df if type_col in df.columns else df.withColumn(type_col, F.lit(side))

    rep = emit_with_derived(
        typed(reported, REPORTED),
        (F.col(wind) > F.lit(threshold)) & (F.col(power) == F.lit(POWER_ON)),
        {power: F.lit(POWER_OFF), type_col: F.lit(DESIRED)},
    )
    des = typed(desired, DESIRED).withColumn("emit_idx", F.lit(0))
    return rep.unionByName(des)


def _state(state_cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in state_cols])


def twin_changelog(inputs: DataFrame, key: str, order: list[str], state_cols: list[str],
                   type_col: str = "type", cfg: ScanConfig | None = None) -> DataFrame:
    """One output per input row: ``(key, order..., desired, reported)`` after
    applying the row.  Rows of other types still emit (state unchanged)."""
    st = _state(state_cols)
    d = (inputs.withColumn("__des", F.when(F.col(type_col) == DESIRED, st))
               .withColumn("__rep", F.when(F.col(type_col) == REPORTED, st)))
    s = running(d, [key], order, {"desired": Agg("last", "__des"), "reported": Agg("last", "__rep")}, cfg)
    return s.select(key, *order, "desired", "reported")


def twin_latest(inputs: DataFrame, key: str, order: list[str], state_cols: list[str],
                type_col: str = "type") -> DataFrame:
    """Final twin per key (the store content without expiry)."""
    st = _state(state_cols)
    ordc = F.struct(*[F.col(o) for o in order])
    return inputs.groupBy(key).agg(
        F.max_by(st, F.when(F.col(type_col) == DESIRED, ordc)).alias("desired"),
        F.max_by(st, F.when(F.col(type_col) == REPORTED, ordc)).alias("reported"),
    )


def twin_ttl(latest: DataFrame, as_of: Column, ts_field: str = "reported.timestamp",
             days: int = TTL_DAYS) -> DataFrame:
    """T5: drop keys whose reported state is ``days`` or more whole days old at
    ``as_of``; keys that never reported stay (their reported state is null)."""
    age = whole_days_between(as_of, F.col(ts_field))
    return latest.where(F.col("reported").isNull() | (age < F.lit(days)))
