"""Reconciliation of keys with many readings, by aggregation and joins instead of windows.

One fact may hold a large share of all rows. Its readings are never brought into one task: what a
step needs to know about a key is an aggregate with partial sums on the map side, and is joined back
to the readings by a name of the key, a skewed join that adaptive execution splits. The readings and
what is known of each key are saved in the shared folder, so a lost executor replays one step. The
flags are those of ``reconcile.flag_readings``, which compares the few readings of a small key
directly and costs one exchange for all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ids import KEY
from ledgerloom.operators import reconcile
from ledgerloom.operators.reconcile import EDITION_RANK, PRIORITY, READING, WINNER
from ledgerloom.operators.scale import find_anchors
from ledgerloom.presets import CorpusPolicy
from ledgerloom.session import cut_lineage

#: Readings of a key up to which each is compared with all others of its key.
WIDE_FROM = 64


def flag_any(observations: DataFrame, policy: CorpusPolicy, wide_from: int = WIDE_FROM) -> DataFrame:
    """``flag_readings`` for observations of any shape: keys above ``wide_from`` readings go the wide way.

    The sizes of the keys are counted first, over the key columns only. Either way the work is linear in
    the readings, as a reading of a smaller key has at most ``wide_from`` others to be compared with.
    """
    sizes = observations.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > wide_from)
    if sizes.isEmpty():
        return reconcile.flag_readings(observations, policy)
    large = cut_lineage(sizes.drop("_n"), "wide-keys").alias("w")
    rows = observations.alias("o")
    same = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"w.{k}")) for k in KEY])
    narrow = reconcile.flag_readings(rows.join(large, same, "left_anti"), policy)
    return narrow.unionByName(flag_wide_readings(rows.join(large, same, "left_semi"), policy))


def key_name() -> Column:
    """One text for the canonical key; null differs from empty, and no two keys share a text."""
    return F.concat(*[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in KEY])


def flag_wide_readings(observations: DataFrame, policy: CorpusPolicy) -> DataFrame:
    """``flag_readings`` without a window; a key of any size is as good as another."""
    band = F.expr(reconcile.metric_setting(policy, "tolerance_permille", "decimal(4,0)")).alias("_band")
    rows = cut_lineage(observations.select("*", band, key_name().alias("_key")), "readings")
    # Zeros are absent exactly where the key has another value, so both candidates for the edition
    # come from one pass and the right one is picked afterwards.
    rank = EDITION_RANK.replace("NOT absent AND ", "")
    nonzero = "CASE WHEN value <> 0 THEN abs(value) END"
    first = cut_lineage(rows.groupBy("_key").agg(
        F.expr(f"max_by({READING}, CASE WHEN value <> 0 THEN {rank} END) AS _edition_nonzero"),
        F.expr(f"max_by({READING}, {rank}) AS _edition_any"),
        F.expr("max(value <> 0) AS _nonzero"), F.expr("count(1) AS readings"),
        # Only keys that span an order of magnitude across publishers can have scale errors.
        F.expr(f"coalesce(max({nonzero}) >= min({nonzero}) * 9BD AND min(source_id) <> max(source_id), false) AS _suspect"),
    ).selectExpr("_key", "_nonzero", "readings", "_suspect", "CASE WHEN _nonzero THEN _edition_nonzero ELSE _edition_any END AS _edition"), "keys")
    staged = rows.join(first, "_key")
    for layer in (
        ["coalesce(_nonzero AND value = 0, false) AS absent"],
        ["NOT absent AND edition_span_end IS NOT NULL AND is_edition_terminal AS partial", f"{reconcile.SUPERSEDED} AS superseded"],
        ["NOT absent AND NOT partial AND NOT superseded AS active"],
    ):
        staged = staged.selectExpr("*", *layer)

    anchors = cut_lineage(find_anchors(staged.filter("_suspect AND active")), "anchors")
    marked = staged.join(anchors, "_key", "left").selectExpr("*", f"{reconcile.SCALE_ERROR} AS scale_error").selectExpr("*", "active AND NOT scale_error AS live")
    winners = cut_lineage(marked.groupBy("_key").agg(
        F.expr(f"min_by({WINNER}, CASE WHEN live THEN {PRIORITY} END) AS winner"), F.expr("max(live OR partial) AS has_fact")), "winners")
    out = marked.join(winners, "_key").selectExpr("*", f"{reconcile.REJECTED} AS rejected")
    return out.select(*observations.columns, "absent", "partial", "superseded", "active", "scale_error", "live", "winner", "rejected", "has_fact", "readings")
