"""Case histories: collated labels, durations, dead ends and unfinished cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigie.operators import cases, workflow
from vigie.registry import ORACLE_CASE_FLOW, SQL_CASE_STEPS, SQL_CASE_TRANS, _case_flow, register
from vigie.sources import seeds
from vigie.sources.fixtures import Fixtures, with_fixtures

# Labels of a tracker in other scripts, as steps and as users typed them.
GREEK_STEPS = [("1", "Άνοιγμα φακέλου"), ("2", "Éléments reçus"), ("3", "Отчёт готов"), ("4", "Clôture")]
_STEPS_SQL = seeds.values_sql(GREEK_STEPS, ["step_code", "step_label"])


@register("W1_case_transitions_scripts", with_fixtures(f"""
with ordered as (select id, dossier_id, action_type, action_date, lead(action_type) over (partition by dossier_id order by id) as next_action_type,
    lead(action_date) over (partition by dossier_id order by id) as next_action_date from fx_case_scripts)
select o.id, o.dossier_id, o.action_type, o.next_action_type, s1.step_code as source_step, s2.step_code as target_step from ordered o
left join {_STEPS_SQL} s1 on lower(strip_accents(rtrim(o.action_type))) = lower(strip_accents(s1.step_label))
left join {_STEPS_SQL} s2 on lower(strip_accents(rtrim(o.next_action_type))) = lower(strip_accents(s2.step_label))
where o.next_action_date is not null""", "fx_case_scripts"))
def q_case_transitions_scripts(spark, sf_dir):
    """W1 on labels in Greek, Latin and Cyrillic that differ in case, accents and trailing blanks."""
    steps = spark.createDataFrame(GREEK_STEPS, "step_code string, step_label string")
    out = workflow.case_transitions(Fixtures(spark, sf_dir).fx_case_scripts, steps)
    return out.select("id", "dossier_id", "action_type", "next_action_type", "source_step", "target_step")


@register("W8_transition_durations", with_fixtures(ORACLE_CASE_FLOW + """,
days as (select source_step, target_step, cast(floor((epoch_us(next_action_date) - epoch_us(action_date)) / 86400000000.0) as bigint) as days from case_flow
  where source_step is not null and target_step is not null and action_date is not null),
numbered as (select *, row_number() over (partition by source_step, target_step order by days) as r, count(*) over (partition by source_step, target_step) as n from days)
select source_step, target_step, count(*) as nb_transitions, avg(days) as mean_days, min(days) as min_days, max(days) as max_days,
  min(case when r >= 0.5 * n then days end) as p50_days, min(case when r >= 0.9 * n then days end) as p90_days
from numbered group by source_step, target_step""", "fx_case_log"))
def q_transition_durations(spark, sf_dir):
    """Counts of two halves of the log, merged."""
    flow = _case_flow(spark, Fixtures(spark, sf_dir))
    halves = [cases.duration_counts(flow.where(F.col("dossier_id") % 2 == k)) for k in (0, 1)]
    return cases.durations(cases.merged_counts(*halves))


@register("W9_unfinished_cases", with_fixtures(f"""
with recursive reach(a, b) as (select from_step, to_step from {SQL_CASE_TRANS} t union select r.a, t.to_step from reach r join {SQL_CASE_TRANS} t on t.from_step = r.b),
ends as (select step_code from {SQL_CASE_STEPS} s where step_code not in (select from_step from {SQL_CASE_TRANS} t)),
last as (select dossier_id, arg_max(action_type, id) as action_type from fx_case_log group by dossier_id),
last_step as (select s.step_code, count(*) as nb_cases from last l left join {SQL_CASE_STEPS} s on lower(strip_accents(rtrim(l.action_type))) = lower(strip_accents(rtrim(s.step_label)))
  group by s.step_code)
select z.step_code, case when z.step_code is not null then z.step_code in (select step_code from ends) end as is_end,
  case when z.step_code is not null then z.step_code in (select step_code from ends) or z.step_code in (select a from reach where b in (select step_code from ends)) end as can_end, nb_cases
from last_step z""", "fx_case_log"))
def q_unfinished_cases(spark, sf_dir):
    return cases.unfinished_cases(Fixtures(spark, sf_dir).fx_case_log, seeds.workflow_steps(spark, "case"), seeds.workflow_transitions(spark, "case"), workflow.label_key)
