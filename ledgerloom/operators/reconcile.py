"""N-way reconciliation: every publisher's reading of a fact in, one decided value out.

``flag_readings`` marks each reading with the step that removed it, and the winner of its key.
``decide`` folds the marked readings into one row per key. All windows and the final aggregation
partition by the same key columns, so the cascade costs one exchange.

Windows hold the readings of a key in one task and compare each with all others, which is right for
facts with a handful of publishers. ``wide.flag_any`` counts the readings of each key first and sends
keys with more of them through aggregates and joins instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ids import KEY
from ledgerloom.functions.numbers import MONEY, agrees, off_by_power_of_ten
from ledgerloom.presets import CorpusPolicy

ABSENT_RULE = "R4-REC-06"
PARTIAL_RULE = "R4-REC-11"
SUPERSEDED_RULE = "R4-REC-10"
SCALE_RULE = "R4-REC-07"
SINGLE_RULE = "R4-REC-04"
AGREED_RULE = "R4-REC-01"
IMMATERIAL_RULE = "R4-REC-08"
STRUCTURAL_RULE = "R4-REC-05"
ONE_PUBLISHER_RULE = "R4-REC-09"
PRIORITY_RULE = "R4-REC-02"

READING = "struct(value, rounding_epsilon, seq)"
WINNER = """struct(value, rounding_epsilon, seq, source_id,
  coalesce(coverage.units_in_source_universe < coverage.units_in_authority, false) AS gap)"""
# Authority: rank, dated before undated and newest first, later edition, source, arrival.
PRIORITY = """struct(authority_rank, coalesce(-unix_micros(source_as_of), 0L) AS as_of,
  coalesce(-try_cast(substring(edition_span_end, 1, 4) AS int), 0) AS edition, source_id, seq)"""
# The editions that may supersede others: latest span first, then first arrival; null for other rows.
EDITION_RANK = """CASE WHEN NOT absent AND edition_span_end IS NOT NULL AND NOT is_edition_terminal
  THEN struct(edition_span_end, -seq) END"""


def metric_setting(policy: CorpusPolicy, pick: str, kind: str) -> str:
    """SQL for a policy attribute of the row's metric, from the configuration."""
    def literal(value: object) -> str:
        text = "NULL" if value is None else f"'{value}'"
        return f"CAST({text} AS {kind})"

    cases = " ".join(
        f"WHEN '{name}' THEN {literal(getattr(settings, pick))}" for name, settings in policy.metrics.items()
    )
    default = literal(getattr(policy.default, pick))
    return f"CASE metric {cases} ELSE {default} END" if cases else default


def pair_agrees(base: str, other: str) -> str:
    """Agreement of two readings given as column prefixes ("" is the row itself)."""
    return agrees(f"{base}value", f"{base}rounding_epsilon", f"{other}value", f"{other}rounding_epsilon", "_band")


SUPERSEDED = f"""coalesce(NOT absent AND edition_span_end IS NOT NULL AND NOT is_edition_terminal
  AND seq <> _edition.seq AND NOT {pair_agrees("_edition.", "")}, false)"""
SCALE_ERROR = f"""coalesce(active AND NOT {pair_agrees("", "_anchor.")}
  AND {off_by_power_of_ten("value", "_anchor.value")}, false)"""
REJECTED = f"coalesce(live AND seq <> winner.seq AND NOT {pair_agrees('winner.', '')}, false)"


def flag_readings(observations: DataFrame, policy: CorpusPolicy) -> DataFrame:
    """``observations`` plus absent, partial, superseded, active, scale_error, live, winner, rejected.

    ``has_fact`` tells whether the key comes to a fact, ``readings`` how many readings it has.
    """
    key = f"OVER (PARTITION BY {', '.join(KEY)})"
    nonzero = "CASE WHEN active AND value <> 0 THEN abs(value) END"
    active_source = "CASE WHEN active THEN source_id END"
    layers = [
        [f"max(value <> 0) {key} AS _nonzero", f"{metric_setting(policy, 'tolerance_permille', 'decimal(4,0)')} AS _band"],
        ["_nonzero AND value = 0 AS absent"],
        ["NOT absent AND edition_span_end IS NOT NULL AND is_edition_terminal AS partial",
         f"max_by({READING}, {EDITION_RANK}) {key} AS _edition"],
        [f"{SUPERSEDED} AS superseded"],
        ["NOT absent AND NOT partial AND NOT superseded AS active"],
        # Only keys that span an order of magnitude across publishers carry their peers along.
        [f"coalesce(max({nonzero}) {key} >= min({nonzero}) {key} * 9BD "
         f"AND min({active_source}) {key} <> max({active_source}) {key}, false) AS _suspect"],
        [f"collect_list(CASE WHEN _suspect AND active THEN struct(value, rounding_epsilon, source_id) END) {key} AS _peers"],
        [f"""CASE WHEN active AND _suspect
          AND exists(_peers, p -> p.source_id <> source_id AND {pair_agrees("", "p.")})
          AND exists(_peers, p -> NOT {pair_agrees("p.", "")} AND {off_by_power_of_ten("p.value", "value")})
          THEN seq END AS _anchor_seq"""],
        [f"min_by({READING}, _anchor_seq) {key} AS _anchor"],
        [f"{SCALE_ERROR} AS scale_error"],
        ["active AND NOT scale_error AS live"],
        [f"min_by({WINNER}, CASE WHEN live THEN {PRIORITY} END) {key} AS winner"],
        [f"{REJECTED} AS rejected", f"max(live OR partial) {key} AS has_fact", f"count(1) {key} AS readings"],
    ]
    df = observations
    for layer in layers:
        df = df.selectExpr("*", *layer)
    return df.drop("_band", "_nonzero", "_edition", "_suspect", "_peers", "_anchor_seq", "_anchor")


SURVIVING = "NOT absent AND NOT scale_error AND NOT partial"


def decide(flagged: DataFrame, policy: CorpusPolicy) -> DataFrame:
    """One row per key: the value, the rule that decided it, and the counts the labels need.

    A key all of whose readings were removed has no fact, unless a terminal partial was among them:
    then the value is withheld. Every aggregate is mergeable, so a key's readings are folded on the
    map side where the plan has not grouped them yet.
    """
    aggregates = [
        "any_value(winner, true) AS winner",
        "count(1) AS sources_seen_count",
        "CASE WHEN count(value) >= 2 THEN max(value) - min(value) END AS seen_spread",
        "count_if(live) AS _live",
        "count_if(rejected) AS rejected_count",
        "count_if(absent) AS absent_count",
        "count_if(partial) AS partial_count",
        "count_if(superseded) AS superseded_count",
        "count_if(scale_error) AS scale_count",
        "min(CASE WHEN live THEN value END) AS _low",
        "max(CASE WHEN live THEN value END) AS _high",
        "min(CASE WHEN live THEN source_id END) AS _first_live",
        "max(CASE WHEN live THEN source_id END) AS _last_live",
        "count_if(live AND coverage IS NULL AND seq <> winner.seq) AS _native",
        f"count_if({SURVIVING}) AS surviving_count",
        f"min(CASE WHEN {SURVIVING} THEN source_id END) AS _first_surviving",
        f"max(CASE WHEN {SURVIVING} THEN source_id END) AS _last_surviving",
        f"max(source_id = '{policy.primary_source}') AS has_primary",
        "array_join(array_sort(collect_set(resource_id)), ';') AS contributing_resource_ids",
    ]
    counted = flagged.groupBy(*KEY).agg(*[F.expr(a) for a in aggregates])
    gap = "greatest(abs(winner.value - _low), abs(winner.value - _high))"
    ruled = counted.filter("_live > 0 OR partial_count > 0").selectExpr(
        "*",
        f"{gap} AS _gap",
        f"{metric_setting(policy, 'absolute_floor', MONEY)} AS _floor",
        f"{metric_setting(policy, 'relative_floor_pct', 'decimal(5,2)')} AS _relative",
        f"""CASE WHEN superseded_count > 0 THEN '{SUPERSEDED_RULE}' WHEN partial_count > 0 THEN '{PARTIAL_RULE}'
          WHEN absent_count > 0 THEN '{ABSENT_RULE}' WHEN scale_count > 0 THEN '{SCALE_RULE}' END AS _removed""",
    ).selectExpr(
        "*",
        f"""CASE WHEN _live = 0 THEN '{PARTIAL_RULE}'
          WHEN _live = 1 THEN coalesce(_removed, '{SINGLE_RULE}')
          WHEN rejected_count = 0 THEN coalesce(_removed, '{AGREED_RULE}')
          WHEN _high - _low < _floor OR _gap * 100BD < abs(winner.value) * _relative THEN '{IMMATERIAL_RULE}'
          WHEN winner.gap AND _native > 0 THEN '{STRUCTURAL_RULE}'
          WHEN _first_live = _last_live THEN '{ONE_PUBLISHER_RULE}'
          ELSE '{PRIORITY_RULE}' END AS resolution_rule_id""",
    ).selectExpr(
        "*",
        f"_live > 0 AND resolution_rule_id NOT IN ('{STRUCTURAL_RULE}', '{ONE_PUBLISHER_RULE}') AS adjudicated",
        "rejected_count > 0 AS disputed",
    )
    return ruled.selectExpr(
        *KEY,
        "CASE WHEN adjudicated THEN winner.value END AS value",
        f"{metric_setting(policy, 'unit', 'string')} AS unit",
        "CASE WHEN adjudicated THEN winner.source_id END AS source_id",
        "resolution_rule_id",
        "adjudicated",
        "disputed",
        # The percentage is for display. A zero winner has no live peer but zeros, so it is never disputed.
        "CASE WHEN disputed THEN CAST(_gap AS double) * 100 / abs(CAST(winner.value AS double)) END AS disagreement_pct",
        f"CASE WHEN disputed THEN resolution_rule_id <> '{IMMATERIAL_RULE}' END AS material",
        "sources_seen_count", "surviving_count", "rejected_count", "absent_count", "partial_count",
        "superseded_count", "scale_count",
        "coalesce(_first_surviving <> _last_surviving, false) AS cross_publisher",
        "has_primary", "contributing_resource_ids", "seen_spread",
    )


def quarantine_impossible(facts: DataFrame, policy: CorpusPolicy) -> DataFrame:
    """Negative values, then values above the physical ceiling, are flagged; the row and value stay.

    The ceiling compares two metrics of one place and year.
    """
    df = facts.selectExpr("*", "coalesce(value < 0, false) AS _negative")
    if policy.ceiling_metric is None:
        above = "false"
    else:
        # Facts are unique by key, so a place and year holds at most one row per metric and month.
        df = df.selectExpr(
            "*",
            f"""max_by(value, CASE WHEN metric = '{policy.ceiling_base}' THEN struct(coalesce(month, '')) END)
            OVER (PARTITION BY scheme, geo_level, state_code, district_code, fin_year) AS _base""",
        )
        above = (
            f"metric = '{policy.ceiling_metric}' AND NOT _negative AND value > _base * {policy.ceiling_factor}BD"
        )
    return df.selectExpr("*", f"coalesce({above}, false) AS _above").selectExpr(
        *facts.columns,
        "_negative OR _above AS quarantined",
        f"CASE WHEN _negative THEN 'negative_value' WHEN _above THEN '{policy.ceiling_reason}' END AS quarantine_reason",
    )
