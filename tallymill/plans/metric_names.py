"""Flat dotted metric names to metric name, labels and type."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.operators.rows import evaluate_once


@dataclass(frozen=True)
class NameMapping:
    match: str
    metric_type: str
    name: str
    labels: Mapping[str, int]  # label -> capture group
    is_regex: bool = False

    @property
    def pattern(self) -> str:
        """In a glob, `*` stands for one dotted part and the whole name must match."""
        if self.is_regex:
            return self.match
        return "^" + "([^.]*)".join(re.escape(part) for part in self.match.split("*")) + "$"


_ID = {"airflow_id": 1}
_DAG = {"airflow_id": 1, "dag_id": 2}
_TASK = {"airflow_id": 1, "dag_id": 2, "task_id": 3}
_FILE = {"airflow_id": 1, "dag_file": 2}
_POOL = {"airflow_id": 1, "pool_name": 2}

# Patterns, names and labels of the workflow metrics, in order of precedence.
MAPPINGS = [
    NameMapping(r"(.+)\.(.+)_start$", "counter", "af_agg_job_start", {"airflow_id": 1, "job_name": 2}, True),
    NameMapping(r"(.+)\.(.+)_end$", "counter", "af_agg_job_end", {"airflow_id": 1, "job_name": 2}, True),
    NameMapping(r"(.+)\.operator_failures_(.+)$", "counter", "af_agg_operator_failures",
             {"airflow_id": 1, "operator_name": 2}, True),
    NameMapping(r"(.+)\.operator_successes_(.+)$", "counter", "af_agg_operator_successes",
             {"airflow_id": 1, "operator_name": 2}, True),
    NameMapping("*.ti_failures", "counter", "af_agg_ti_failures", _ID),
    NameMapping("*.ti_successes", "counter", "af_agg_ti_successes", _ID),
    NameMapping("*.zombies_killed", "counter", "af_agg_zombies_killed", _ID),
    NameMapping("*.scheduler_heartbeat", "counter", "af_agg_scheduler_heartbeat", _ID),
    NameMapping("*.dag_processing.processes", "counter", "af_agg_dag_processing_processes", _ID),
    NameMapping("*.scheduler.tasks.killed_externally", "counter", "af_agg_scheduler_tasks_killed_externally", _ID),
    NameMapping("*.scheduler.tasks.running", "counter", "af_agg_scheduler_tasks_running", _ID),
    NameMapping("*.scheduler.tasks.starving", "counter", "af_agg_scheduler_tasks_starving", _ID),
    NameMapping("*.scheduler.orphaned_tasks.cleared", "counter", "af_agg_scheduler_orphaned_tasks_cleared", _ID),
    NameMapping("*.scheduler.orphaned_tasks.adopted", "counter", "af_agg_scheduler_orphaned_tasks_adopted", _ID),
    NameMapping("*.scheduler.critical_section_busy", "counter", "af_agg_scheduler_critical_section_busy", _ID),
    NameMapping("*.sla_email_notification_failure", "counter", "af_agg_sla_email_notification_failure", _ID),
    NameMapping("*.ti.start.*.*", "counter", "af_agg_ti_start", _TASK),
    NameMapping("*.ti.finish.*.*.*", "counter", "af_agg_ti_finish", {**_TASK, "state": 4}),
    NameMapping("*.dag.callback_exceptions", "counter", "af_agg_dag_callback_exceptions", _ID),
    NameMapping("*.celery.task_timeout_error", "counter", "af_agg_celery_task_timeout_error", _ID),
    NameMapping("*.dagbag_size", "gauge", "af_agg_dagbag_size", _ID),
    NameMapping("*.dag_processing.import_errors", "gauge", "af_agg_dag_processing_import_errors", _ID),
    NameMapping("*.dag_processing.total_parse_time", "gauge", "af_agg_dag_processing_total_parse_time", _ID),
    NameMapping("*.dag_processing.last_runtime.*", "gauge", "af_agg_dag_processing_last_runtime", _FILE),
    NameMapping("*.dag_processing.last_run.seconds_ago.*", "gauge", "af_agg_dag_processing_last_run_seconds", _FILE),
    NameMapping("*.dag_processing.processor_timeouts", "gauge", "af_agg_dag_processing_processor_timeouts", _ID),
    NameMapping("*.executor.open_slots", "gauge", "af_agg_executor_open_slots", _ID),
    NameMapping("*.executor.queued_tasks", "gauge", "af_agg_executor_queued_tasks", _ID),
    NameMapping("*.executor.running_tasks", "gauge", "af_agg_executor_running_tasks", _ID),
    NameMapping("*.pool.open_slots.*", "gauge", "af_agg_pool_open_slots", _POOL),
    NameMapping("*.pool.queued_slots.*", "gauge", "af_agg_pool_queued_slots", _POOL),
    NameMapping("*.pool.running_slots.*", "gauge", "af_agg_pool_running_slots", _POOL),
    NameMapping("*.pool.starving_tasks.*", "gauge", "af_agg_pool_starving_tasks", _POOL),
    NameMapping("*.smart_sensor_operator.poked_tasks", "gauge", "af_agg_smart_sensor_operator_poked_tasks", _ID),
    NameMapping("*.smart_sensor_operator.poked_success", "gauge", "af_agg_smart_sensor_operator_poked_success", _ID),
    NameMapping("*.smart_sensor_operator.poked_exception", "gauge", "af_agg_smart_sensor_operator_poked_exception", _ID),
    NameMapping("*.smart_sensor_operator.exception_failures", "gauge",
             "af_agg_smart_sensor_operator_exception_failures", _ID),
    NameMapping("*.smart_sensor_operator.infra_failures", "gauge", "af_agg_smart_sensor_operator_infra_failures", _ID),
    NameMapping("*.dagrun.dependency-check.*", "observer", "af_agg_dagrun_dependency_check", _DAG),
    NameMapping("*.dag.*.*.duration", "observer", "af_agg_dag_task_duration", _TASK),
    NameMapping("*.dag_processing.last_duration.*", "observer", "af_agg_dag_processing_duration", _FILE),
    NameMapping("*.dagrun.duration.success.*", "observer", "af_agg_dagrun_duration_success", _DAG),
    NameMapping("*.dagrun.duration.failed.*", "observer", "af_agg_dagrun_duration_failed", _DAG),
    NameMapping("*.dagrun.schedule_delay.*", "observer", "af_agg_dagrun_schedule_delay", _DAG),
    NameMapping("*.scheduler.critical_section_duration", "observer", "af_agg_scheduler_critical_section_duration", _ID),
    NameMapping("*.dagrun.*.first_task_scheduling_delay", "observer", "af_agg_dagrun_first_task_scheduling_delay", _DAG),
]


RULE = "struct<metric:string,metric_type:string,labels:map<string,string>>"


def _rule(raw: Column, mappings: Sequence[NameMapping]) -> Column:
    """Metric, type and labels by the first pattern that a name matches; null if none does."""
    found = F.lit(None).cast(RULE)
    for m in reversed(mappings):
        labels = [x for label, group in m.labels.items() for x in (F.lit(label), F.regexp_extract(raw, m.pattern, group))]
        made = F.struct(F.lit(m.name).alias("metric"), F.lit(m.metric_type).alias("metric_type"), F.create_map(*labels).alias("labels"))
        found = F.when(raw.rlike(m.pattern), made).otherwise(found)
    return found


def map_names(names: DataFrame, column: str, mappings: Sequence[NameMapping] = MAPPINGS) -> DataFrame:
    """(column, metric, metric_type, labels) of the first pattern each name matches; other names go."""
    return map_metrics(names.select(column, F.col(column).alias("_name")), "_name", mappings).select(
        column, "metric", "metric_type", "labels"
    )


def map_metrics(raw: DataFrame, column: str, mappings: Sequence[NameMapping] = MAPPINGS) -> DataFrame:
    """Samples with `metric`, `metric_type` and `labels` in place of the flat name; unmatched names go.

    A name's mapping depends on the name alone, so it is found in the sample's own row, without a
    join. Patterns are literals, compiled once.
    """
    rest = [c for c in raw.columns if c != column]
    # evaluated once: the null filter would otherwise repeat the patterns
    ruled = evaluate_once(raw, "_rule", _rule(F.col(column), mappings)).where("_rule IS NOT NULL")
    return ruled.select("_rule.metric", "_rule.metric_type", "_rule.labels", *rest)
