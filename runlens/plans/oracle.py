"""DuckDB SQL for every registered query, over the same raw tables.

Written independently of the Spark expressions: printf for exact rounding, joins and anti-joins
where Spark groups a union, plain windows where Spark splits large groups.
"""

from runlens.plans.queries import GENERATED_AT, KNOWN_DOMAINS, LABELLER, VERSION
from runlens.schemas import (
    DASHBOARD_COLUMNS, DRIFT_KINDS, EXTRACT, HEALTH_COLUMNS, LABELS, METRICS, QUEUE_COLUMNS,
    RECORD_COLUMNS, RUNS, STATUSES,
)

RUN_COLS = ", ".join(RUNS.fieldNames())
METRIC_COLS = ", ".join(METRICS.fieldNames())


#: Fixed value: sha256 of the question of version v1, taken down when it was settled.
QUESTION_HASH = "3c805450b3ec93faa4dcb30f0f590e6cc3a23bd4cfacf22c85aadfffef8c5fa9"


def _texts(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _ratio(numerator: str, denominator: str) -> str:
    return (
        f"case when {denominator} is null or {denominator} = 0 then cast(0 as double) "
        f"else cast(printf('%.6f', ({numerator}) / {denominator}) as double) + 0.0 end"
    )


_RUNS = """
li as (
  select s_name, r_name, date_trunc('month', l_shipdate) as m, l_shipdate,
         cast(round(l_quantity) as bigint) as q, l_returnflag, l_linestatus, l_linenumber
  from lineitem join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
a as (
  select s_name, r_name, m, count(*) as n,
    cast(sum(q) as bigint) as expected_rows,
    cast(sum(case when l_returnflag = 'R' and l_linestatus = 'F' then 0 else q end) as bigint) as actual_rows,
    cast(sum(case when l_returnflag = 'R' and l_linestatus = 'O' and l_linenumber >= 4 then q else 0 end)
      as bigint) as failed_rows,
    cast(sum(l_linenumber) * 30 as bigint) as duration_seconds,
    cast(count(*) * 120 as bigint) as expected_duration_seconds,
    cast((extract(day from min(l_shipdate)) - 1) * 20 as bigint) as freshness_delay_minutes
  from li group by s_name, r_name, m),
runs as (
  select lower(replace(s_name, '#', '_')) || '_' || strftime(m, '%Y%m%d') as run_id,
    lower(replace(s_name, '#', '_')) as pipeline_name, lower(r_name) as domain,
    strftime(m, '%Y-%m-%dT%H:%M:%S') as run_timestamp,
    expected_rows, actual_rows, failed_rows, duration_seconds, expected_duration_seconds,
    freshness_delay_minutes,
    case when n % 11 = 0 then 'type_changed' when n % 7 = 0 then 'column_added'
         when n % 13 = 0 then 'column_removed' else 'none' end as schema_drift,
    case when failed_rows * 5 >= expected_rows then 'failed'
         when actual_rows * 10 < expected_rows * 9 or failed_rows * 200 > expected_rows then 'degraded'
         else 'healthy' end as status,
    case when failed_rows * 5 >= expected_rows then 'upstream rows rejected'
         when failed_rows * 200 > expected_rows and n % 2 = 0
         then 'row count variance above warn threshold' end as error_message
  from a)"""


def _metrics(name: str, source: str) -> str:
    return f"""
{name} as (
  select {RUN_COLS},
    {_ratio("failed_rows", "expected_rows")} as failure_rate,
    {_ratio("actual_rows - expected_rows", "expected_rows")} as row_count_variance,
    {_ratio("duration_seconds - expected_duration_seconds", "expected_duration_seconds")}
      as duration_variance,
    case when freshness_delay_minutes <= 15 then 'ON_TIME' when freshness_delay_minutes <= 60 then 'MINOR'
         when freshness_delay_minutes <= 240 then 'MAJOR' when freshness_delay_minutes > 240 then 'SEVERE'
         end as freshness_severity,
    coalesce(schema_drift, '') not in ('', 'none') as schema_drift_present,
    coalesce(error_message, '') <> '' as error_present
  from {source})"""


_LABELS = """
lv as (
  select run_id, freshness_delay_minutes as f,
    case freshness_severity when 'ON_TIME' then 0 when 'MINOR' then 1 when 'MAJOR' then 2 else 3 end as lf,
    case status when 'healthy' then 0 when 'degraded' then 1 else 3 end as ls,
    case when failure_rate < 0.01 then 0 when failure_rate < 0.03 then 1
         when failure_rate < 0.2 then 2 else 3 end as lr,
    case when schema_drift = 'none' then 0 else 2 end as ld
  from metrics),
decisions as (
  select run_id,
    case greatest(lf, ls) when 0 then 'HEALTHY' when 1 then 'WATCH' when 2 then 'INVESTIGATE'
      else 'BLOCK' end as decision,
    case when f % 140 = 100 then null
      else cast((lf = greatest(lf, ls))::int + (ls = greatest(lf, ls))::int
        + (lr = greatest(lf, ls))::int + (ld = greatest(lf, ls))::int as double) / 4 end as confidence
  from lv)"""

_FINAL = """
final as (
  select m.*, d.decision as label_decision, d.confidence as label_confidence
  from metrics m join decisions d on m.run_id = d.run_id)"""

_BROKEN_DECISIONS = """
bd as (
  select d.run_id, case when expected_rows % 83 = 0 then 'MAYBE' else decision end as decision, confidence
  from decisions d join runs r on d.run_id = r.run_id where expected_rows % 97 <> 0
  union all
  select d.run_id, case when expected_rows % 83 = 0 then 'MAYBE' else decision end, confidence
  from decisions d join runs r on d.run_id = r.run_id
  where expected_rows % 97 <> 0 and expected_rows % 89 = 0
  union all select 'ghost_' || lower(r_name), 'WATCH', 0.5 from region
  union all select 'null_label', null, 0.5
  union all select null, 'WATCH', 0.5),
dn as (
  select run_id, count(*) as n,
    count(*) filter (where decision is null
      or decision not in ('HEALTHY', 'WATCH', 'INVESTIGATE', 'BLOCK')) as bad
  from bd group by run_id)"""

_BROKEN_RUNS = """
br1 as (
  select run_id, pipeline_name, domain, run_timestamp, expected_rows, actual_rows,
    case when expected_rows % 103 = 0 then expected_rows + 1 else failed_rows end as failed_rows,
    duration_seconds, expected_duration_seconds,
    case when expected_rows % 113 = 0 then -5 else freshness_delay_minutes end as freshness_delay_minutes,
    case when expected_rows % 109 = 0 then 'renamed' else schema_drift end as schema_drift,
    case when expected_rows % 107 = 0 then null else status end as status,
    error_message
  from runs),
br as (select * from br1 union all select * from br1 where expected_rows % 101 = 0)"""

_DRIFTED = """
drifted as (
  select * replace (case when expected_rows % 97 = 0 then failure_rate + 0.001 else failure_rate end
    as failure_rate) from final)"""

_INCOMING = """
incoming as (
  select * replace (actual_rows + 1000 as actual_rows) from runs where expected_rows % 101 = 0
  union all
  select lower(r_name) || '_20020101', lower(r_name), lower(r_name), '2002-01-01T00:00:00',
    100, 100, 0, 60, 60, 5, 'none', 'healthy', null from region),
merged as (
  select * from incoming
  union all select * from runs where run_id not in (select run_id from incoming))"""

# rule -> condition that is true on a violating run, in the order of the reason codes
_RULES = [(f"null_{f.name}", f"{f.name} is null") for f in RUNS.fields if not f.nullable] + [
    ("failed_rows_out_of_range", "failed_rows < 0 or failed_rows > expected_rows"),
    ("duration_not_positive", "duration_seconds <= 0"),
    ("negative_delay", "freshness_delay_minutes < 0"),
    ("failed_with_low_failure_rate", "status = 'failed' and failed_rows / expected_rows < 0.2"),
    ("failed_without_error", "status = 'failed' and coalesce(error_message, '') = ''"),
    ("healthy_with_error", "status = 'healthy' and coalesce(error_message, '') <> ''"),
    ("unknown_status", f"status not in ({_texts(STATUSES)})"),
    ("unknown_drift", f"schema_drift not in ({_texts(DRIFT_KINDS)})"),
]

_LABEL_RULES = [
    ("failed_not_blocked", "status = 'failed' and label_decision <> 'BLOCK'"),
    ("healthy_not_healthy", "status = 'healthy' and label_decision <> 'HEALTHY'"),
    ("degraded_without_attention",
     "status = 'degraded' and label_decision not in ('WATCH', 'INVESTIGATE')"),
    ("healthy_label_high_failure_rate", "label_decision = 'HEALTHY' and failure_rate >= 0.01"),
    ("confidence_out_of_range", "label_confidence < 0 or label_confidence > 1"),
]


def _rule_counts(rules: list[tuple[str, str]], source: str) -> str:
    return " union all ".join(
        f"select '{name}' as rule, count(*) filter (where {condition}) as violations from {source}"
        for name, condition in rules
    )


def _reasons(copies: str) -> str:
    cases = [f"case when {c} then '{n}' end" for n, c in _RULES]
    return f"concat_ws(',', {', '.join(cases)}, case when {copies} then 'duplicate_run_id' end)"


_COPIES = "kn as (select run_id as k, count(*) as copies from br group by run_id)"
_LABEL_COUNTS = ", ".join(
    f"count(*) filter (where label_decision = '{name}') as \"{name}\"" for name in LABELS
)
_DASHBOARD = ", ".join(DASHBOARD_COLUMNS)
_EXTRACT = ", ".join(EXTRACT.fieldNames())


def _field_diff(name: str, is_double: bool) -> str:
    """One comparison of a reconciled pair l, r whose key occurs once on each side."""
    differs = f"l.{name} is distinct from r.{name}"
    text = "l.{0}::varchar, r.{0}::varchar"
    if is_double:
        differs = f"({differs}) and coalesce(abs(l.{name} - r.{name}) >= 1e-9, true)"
        text = "printf('%.6f', l.{0}), printf('%.6f', r.{0})"
    return (
        f"select l.run_id, '{name}' as field, {text.format(name)} "
        f"from lt l join rt r on l.run_id = r.run_id where {differs}"
    )


def _reconcile(columns: list[tuple[str, bool]]) -> str:
    fields = " union all ".join(_field_diff(*c) for c in columns)
    return f"""
    select coalesce(l.run_id, r.run_id) as run_id, 'rows' as field,
      (case when l.run_id is null then '0' else '1' end) as left_value,
      (case when r.run_id is null then '0' else '1' end) as right_value
    from lt l full join rt r on l.run_id = r.run_id where l.run_id is null or r.run_id is null
    union all {fields}"""


_DOUBLES = {"failure_rate", "row_count_variance", "duration_variance", "label_confidence"}


def _recompute() -> str:
    columns = [c for c in METRICS.fieldNames() if c not in RUNS.fieldNames()]
    return " union all ".join(
        f"select run_id, field, left_value, right_value from ({_field_diff(c, c in _DOUBLES)}) "
        "as d(run_id, field, left_value, right_value)"
        for c in columns
    )


def _canonical() -> str:
    """One text per extract row, as the fingerprint defines it."""
    fields = []
    for f in EXTRACT.fields:
        text = f"printf('%.6f', {f.name} + 0.0)" if f.name in _DOUBLES else f"{f.name}::varchar"
        fields.append(f"coalesce('V' || length({text}) || ':' || {text}, 'N')")
    return " || ".join(fields)


def _digest_sums() -> str:
    parts = [f"cast(coalesce(sum(('0x' || substr(d, {first}, 15))::bigint), 0) as varchar)"
             for first in (1, 16, 31, 46, 61)]
    return " || '-' || ".join(parts)


_FINGERPRINT = f"""
fp as (
  select count(*) as row_count, {_digest_sums()} as digest_sum
  from (select sha256({_canonical()}) as d from metrics))"""

_DAILY_HEALTH = """
  select run_timestamp[1:10] as day, domain, count(*) as runs,
    cast(printf('%.6f', cast(sum(cast(failure_rate as decimal(18, 6))) as double) / count(*)) as double) + 0.0
      as mean_failure_rate
  from metrics group by all"""

_HEALTH = """
  select pipeline_name, min_by(domain, run_id) as domain, count(*) as total_runs,
    floor(count(*) filter (where label_decision = 'HEALTHY') / count(*) * 1000 + 0.5) / 10 as healthy_pct,
    count(*) filter (where label_decision in ('WATCH', 'INVESTIGATE')) as attention_runs,
    count(*) filter (where label_decision = 'BLOCK') as blocked_runs,
    floor(cast(sum(freshness_delay_minutes) as double) / count(*) * 100 + 0.5) / 100 as avg_freshness_delay,
    floor(cast(sum(cast(failure_rate as decimal(18, 6))) as double) / count(*) * 100 + 0.5) / 100
      as avg_failure_rate
  from final group by pipeline_name"""

_KPI_BY_LABEL = f"""
  select count(*) as total,
    case when count(*) = 0 then 0.0
      else count(*) filter (where label_decision = 'HEALTHY') / count(*) * 100 end as healthy_pct,
    count(*) filter (where label_decision in ('WATCH', 'INVESTIGATE')) as attention,
    count(*) filter (where label_decision = 'BLOCK') as blocked, {_LABEL_COUNTS}
  from final"""

# the share is rounded to five decimals and then to four, halves up, as an average of 1.0 and 0.0 is
_KPI = """
  select n as total_runs,
    ((200000 * h + n) // (2 * n) + 5) // 10 / cast(10000 as double) as healthy_share,
    requires_attention, blocked
  from (select count(*) as n, count(*) filter (where label_decision = 'HEALTHY') as h,
    count(*) filter (where label_decision in ('WATCH', 'INVESTIGATE')) as requires_attention,
    count(*) filter (where label_decision = 'BLOCK') as blocked from final)"""

_QUEUE_COMPACT = """
  select pipeline_name, domain, label_decision, label_confidence, status, freshness_severity
  from final where label_decision in ('INVESTIGATE', 'BLOCK')"""

_ALERTS = """
  select run_id, pipeline_name, domain, run_timestamp, label_decision, previous_decision, alert from (
    select *, case
        when label_decision = 'BLOCK' and previous_decision is distinct from 'BLOCK' then 'NEWLY_BLOCKED'
        when list_position(['HEALTHY', 'WATCH', 'INVESTIGATE', 'BLOCK'], label_decision)
           > list_position(['HEALTHY', 'WATCH', 'INVESTIGATE', 'BLOCK'], previous_decision)
        then 'WORSENED' end as alert
    from (select *, lag(label_decision) over (partition by pipeline_name order by run_timestamp, run_id)
      as previous_decision from final))
  where alert is not null"""

_VIOLATIONS = """
  select run_id, 'missing' as violation from runs where run_id not in (select run_id from dn where run_id is not null)
  union all
  select run_id, 'extra' from dn where run_id is null or run_id not in (select run_id from runs)
  union all select run_id, 'duplicate' from dn where n > 1
  union all select run_id, 'bad_label' from dn where bad > 0"""

_COVERAGE = f"""
  select (select count(*) from runs) as source_runs, (select count(*) from bd) as decisions,
    count(*) filter (where violation = 'missing') as missing_ids,
    count(*) filter (where violation = 'extra') as extra_ids,
    count(*) filter (where violation = 'duplicate') as duplicate_ids,
    cast(0 as bigint) as source_duplicate_ids,
    (select cast(sum(bad) as bigint) from dn) as bad_labels
  from ({_VIOLATIONS})"""


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + " "


def oracle_sql() -> dict[str, str]:
    runs = _with(_RUNS)
    metrics = _with(_RUNS, _metrics("metrics", "runs"))
    labelled = (_RUNS, _metrics("metrics", "runs"), _LABELS)
    decisions = _with(*labelled)
    final = _with(*labelled, _FINAL)
    broken_decisions = _with(*labelled, _FINAL, _BROKEN_DECISIONS)
    broken_runs = _with(_RUNS, _BROKEN_RUNS)
    drifted = (*labelled, _FINAL, _DRIFTED)
    all_runs = f"select {RUN_COLS} from runs"
    all_metrics = f"select {METRIC_COLS} from metrics"
    all_final = "select * from final"
    all_decisions = "select run_id, decision, confidence from decisions"
    dashboard = f"select {_DASHBOARD} from final"
    sql = {
        "run_rollup": runs + all_runs,
        "runs_csv": runs + all_runs,
        "metrics_full": metrics + all_metrics,
        "metrics_table": metrics + all_metrics,
        "stream_merge": metrics + all_metrics,
        "load_latest": metrics + all_metrics,
        "sql_metrics": metrics + all_metrics,
        "resumed_labels": decisions + all_decisions,
        "report_cube": final + """
            select domain, label_decision, schema_drift_present,
              cast(grouping_id(domain, label_decision, schema_drift_present) as integer) as level, count(*) as runs,
              cast(sum(freshness_delay_minutes) as bigint) as delay_minutes,
              cast(sum(floor(failure_rate * 1e6 + 0.5)) as bigint) as rate_micros
            from final group by cube (domain, label_decision, schema_drift_present)""",
        "daily_after_load": metrics + _DAILY_HEALTH,
        "request_payload": metrics + f"select {_EXTRACT} from metrics",
        "recorded_labels": decisions + all_decisions,
        "malformed_rows": runs + """
            select run_id, 'null_expected_rows,malformed_record' as reasons from runs where expected_rows % 127 = 0""",
        "rollup_unmatched": """
            select case when l_quantity = 7 or l_suppkey is null then 'no supplier' else 'unknown supplier' end as reason,
              count(*) as lines, cast(sum(round(l_quantity)) as bigint) as quantity
            from lineitem
            where l_quantity in (7, 11) or l_suppkey is null or l_suppkey not in (select s_suppkey from supplier)
            group by 1""",
        "catalog_table": metrics + all_metrics,
        "stream_metrics": metrics + all_metrics,
        "metric_record": metrics + f"select {', '.join(RECORD_COLUMNS)} from metrics",
        "decision_extract": metrics + f"select {_EXTRACT} from metrics",
        "extract_json": metrics + f"select {_EXTRACT} from metrics",
        "stream_domain_daily": metrics + _DAILY_HEALTH,
        "run_ordinal": runs + """
            select run_id, pipeline_name, run_timestamp, run_ordinal,
              pipeline_name || '_' || replace(run_timestamp[1:10], '-', '') || '_' || run_ordinal as run_key
            from (select *, row_number() over (
              partition by pipeline_name order by run_timestamp, run_id) - 1 as run_ordinal from runs)""",
        "policy_labels": decisions + all_decisions,
        "scored_labels": decisions + all_decisions,
        "decisions_json": decisions + all_decisions,
        "input_fingerprint": _with(_RUNS, _metrics("metrics", "runs"), _FINGERPRINT) + """
            select row_count, digest_sum, sha256(row_count || ':' || digest_sum) as fingerprint from fp""",
        "maintained_fingerprint": _with(_RUNS, _metrics("metrics", "runs"), _FINGERPRINT) + """
            select row_count, digest_sum, sha256(row_count || ':' || digest_sum) as fingerprint from fp""",
        "label_job_meta": _with(_RUNS, _metrics("metrics", "runs"), _FINGERPRINT) + f"""
            select '{LABELLER}' as labeller, '{VERSION}' as version,
              '{QUESTION_HASH}' as question_hash,
              sha256(row_count || ':' || digest_sum) as input_hash, row_count as count,
              '{GENERATED_AT}' as generated_at from fp""",
        "final_analytics": final + all_final,
        "final_export": final + all_final,
        "clean_final": broken_decisions + f"""
            select m.*, bd.decision as label_decision, bd.confidence as label_confidence
            from metrics m join bd on m.run_id = bd.run_id
            where m.run_id not in (select run_id from ({_VIOLATIONS}) where run_id is not null)""",
        "coverage_report": broken_decisions + _COVERAGE,
        "coverage_violations": broken_decisions + _VIOLATIONS,
        "duplicate_runs": broken_runs
        + "select run_id, count(*) as copies from br group by run_id having count(*) > 1",
        "kpi_summary": final + _KPI,
        "kpi_by_label": final + _KPI_BY_LABEL,
        "kpi_display": final + f""", k as ({_KPI_BY_LABEL})
            select 'total' as card, total::varchar as value from k
            union all select 'healthy_pct', printf('%.1f', healthy_pct) || '%' from k
            union all select 'attention', attention::varchar from k
            union all select 'blocked', blocked::varchar from k""",
        "decision_distribution": final
        + "select label_decision, count(*) as runs from final group by label_decision",
        "domain_decision": final
        + "select domain, label_decision, count(*) as runs from final group by domain, label_decision",
        "domain_decision_pivot": final
        + f"select domain, {_LABEL_COUNTS} from final group by domain",
        "status_confusion": final + f"select status, {_LABEL_COUNTS} from final group by status",
        "mean_freshness": final + """
            select pipeline_name,
              floor(cast(sum(freshness_delay_minutes) as double) / count(*) * 100 + 0.5) / 100
                as avg_freshness_delay
            from final group by pipeline_name""",
        "health_table": final + _HEALTH,
        "health_display": final + f"""
            select pipeline_name, domain, total_runs, printf('%.1f', healthy_pct) || '%' as healthy_pct,
              attention_runs, blocked_runs, printf('%.2f', avg_freshness_delay) as avg_freshness_delay,
              printf('%.2f', avg_failure_rate) as avg_failure_rate
            from ({_HEALTH})""",
        "health_runs": final + f"select {', '.join(HEALTH_COLUMNS)} from final",
        "freshness_trend": final
        + "select run_timestamp, freshness_delay_minutes, label_decision from final",
        "queue_runs": final + f"""
            select {', '.join(QUEUE_COLUMNS)} from final where label_decision in ('INVESTIGATE', 'BLOCK')""",
        "queue_compact": final + _QUEUE_COMPACT,
        "queue_display": final + f"""
            select * replace (coalesce(printf('%.2f', label_confidence), 'n/a') as label_confidence)
            from ({_QUEUE_COMPACT})""",
        "filtered_runs": final + """
            select * from final where domain in ('asia', 'europe')
              and label_decision in ('WATCH', 'INVESTIGATE') and schema_drift_present""",
        "runs_preview": runs + all_runs + " order by run_id limit 5",
        "source_profile": broken_runs
        + "select count(*) as total_runs, count(distinct run_id) as distinct_run_ids from br",
        "domain_profile": runs + """
            select domain, count(*) as runs, count(*) filter (where status = 'healthy') as healthy,
              count(*) filter (where status = 'degraded') as degraded,
              count(*) filter (where status = 'failed') as failed
            from runs group by domain""",
        "dashboard_extract": final + dashboard,
        "dashboard_from_csv": final + dashboard,
        "alert_rows": final + _ALERTS,
        "alerts_after_load": final + _ALERTS,
        "rollup_after_lines": runs + all_runs,
        "expectation_report": broken_runs
        + _rule_counts([*_RULES, ("unknown_domain", f"domain not in ({_texts(KNOWN_DOMAINS)})")], "br")
        + " union all select 'duplicate_run_id', count(*) from "
        "(select run_id from br group by run_id having count(*) > 1)",
        "label_quality": final + _rule_counts(_LABEL_RULES, "final"),
        "quarantine_rows": broken_runs + f""", {_COPIES}
            select * from (select br.*, {_reasons('copies > 1')} as reasons
              from br join kn on br.run_id = kn.k) where reasons <> ''""",
        "valid_rows": broken_runs + f""", {_COPIES}
            select * exclude (reasons) from (select br.*, {_reasons('copies > 1')} as reasons
              from br join kn on br.run_id = kn.k) where reasons = ''""",
        "recompute_diff": _with(*drifted, "lt as (select * from drifted)",
                                _metrics("rt", "drifted")) + _recompute(),
        "extract_diff": _with(*drifted, f"lt as (select {_EXTRACT} from drifted)",
                              f"rt as (select {_EXTRACT} from metrics)")
        + _reconcile([(c, c in _DOUBLES) for c in EXTRACT.fieldNames() if c != "run_id"]),
        "reconcile_diff": _with(
            *drifted, f"lt as (select {_DASHBOARD} from final)",
            f"rt as (select {_DASHBOARD} from drifted where expected_rows % 89 <> 0)")
        + _reconcile([(c, c in _DOUBLES) for c in DASHBOARD_COLUMNS if c != "run_id"]),
        "latest_runs": _with(_RUNS, _INCOMING) + f"select {RUN_COLS} from merged",
        "partition_upsert": _with(_RUNS, _INCOMING) + f"select {RUN_COLS} from merged",
        "pruned_domain_scan": metrics + """
            select run_id, domain, run_timestamp[1:10] as run_date, expected_rows, failure_rate
            from metrics where domain = 'asia' and run_timestamp >= '1997' and run_timestamp < '1998'""",
    }
    sql["reconcile_ranges"] = sql["reconcile_diff"]
    for name in ("failure_rate", "row_count_variance", "duration_variance", "freshness_severity",
                 "schema_drift_present", "error_present"):
        sql[name] = metrics + f"select run_id, {name} from metrics"
    return sql
