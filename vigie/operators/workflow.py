"""Workflow mining on audit histories.

Audit rows are processed row-locally where the reference regroups: the JSON change list is parsed with ``from_json``
and the old value of each status field is read with ``filter``/``element_at`` on the array, so no explode + regroup
shuffle is needed. Keep-first rules use ``row_number`` windows with explicit NULL ordering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHANGE_SCHEMA = "array<struct<field:string,old_value:string,new_value:string>>"
STATUS_FIELDS = ("detection_validation_status", "detection_control_status", "detection_prescription_status")
# Who stands for imports in the baseline unless the caller says otherwise, and the status before any import.
IMPORT_EMAIL, IMPORT_GROUP, IMPORTED = "import@example.org", "import", "IMPORTED"


#: Labels that differ in case, accents or trailing blanks only are equal, in any script.
LABEL_COLLATION = "UNICODE_CI_AI_RTRIM"


def label_key(c: Column) -> Column:
    """Comparison key of labels for joins and grouping, under the tracker's collation."""
    return F.collate(c, LABEL_COLLATION)


def case_transitions(log: DataFrame, steps: DataFrame, town: str | None = None, order_col: str = "id") -> DataFrame:
    """Next action and date per case (ordered by ``order_col``), labels mapped to step codes (unmapped → NULL);
    the last event of a case (no next date) is dropped."""
    d = log if town is None else log.where(F.col("ville") == town)
    w = Window.partitionBy("dossier_id").orderBy(order_col)
    d = d.select("*", F.lead("action_type").over(w).alias("next_action_type"), F.lead("action_date").over(w).alias("next_action_date"))
    st = steps.select(label_key(F.col("step_label")).alias("_k"), "step_code")
    d = d.join(st.withColumnRenamed("step_code", "source_step"), label_key(F.col("action_type")) == F.col("_k"), "left").drop("_k")
    d = d.join(st.withColumnRenamed("step_code", "target_step"), label_key(F.col("next_action_type")) == F.col("_k"), "left").drop("_k")
    return d.where(F.col("next_action_date").isNotNull())


def study_scope(versions: DataFrame, zones: DataFrame, territory_id: int, risk_ids: list[int], cell: float) -> DataFrame:
    """``version_id`` of the detection versions that lie within the territory and within one of the risk zones.

    Each version is tested by its own geometry: a detection that moved out of the area keeps only the versions inside.
    ``versions``: a layer whose id is the version.
    """
    from vigie.operators.spatial import zone_tag

    tags = zone_tag(versions, zones, cell, [territory_id, *risk_ids])
    inside = tags.groupBy("id").agg(F.max((F.col("zone_id") == territory_id).cast("int")).alias("t"), F.max(F.col("zone_id").isin(risk_ids).cast("int")).alias("r"))
    return inside.where("t = 1 and r = 1").select(F.col("id").alias("version_id"))


def reviewed(hist_det: DataFrame, tileset: int = 19, min_score: float = 0.3) -> DataFrame:
    """Versions of one tileset above a score; taken before the study area, so only these are tested against zones."""
    return hist_det.where((F.col("tile_set_id") == tileset) & (F.col("score") > min_score))


def scoped_versions(hist_det: DataFrame, hist_objects: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """Detections under study as ``(detection_id, detection_data_id, auto_prescribed, parcel_id)``: versions, optionally those
    in ``scope(version_id)`` only, left-joined to the history of the detection's object for the parcel. W2 and W3 both read it."""
    if scope is not None:
        hist_det = hist_det.join(scope.select("version_id"), "version_id", "left_semi")
    det = hist_det.select(F.col("id").alias("detection_id"), "detection_data_id", "detection_object_id", "auto_prescribed")
    objects = hist_objects.select(F.col("id").alias("detection_object_id"), "parcel_id")
    return det.join(objects, "detection_object_id", "left").drop("detection_object_id")


def _audited(hist_data: DataFrame, versions: DataFrame) -> DataFrame:
    """Audit rows of the detections under study; ``hist_data`` is filtered by the caller first."""
    return hist_data.join(versions, hist_data["id"] == versions["detection_data_id"]).drop(hist_data["id"])


def _status(a: Column, b: Column, c: Column) -> Column:
    return F.concat(a, F.lit("."), b, F.lit("."), c)  # NULL-propagating like ||


def import_baseline(hist_data: DataFrame, versions: DataFrame, email: str = IMPORT_EMAIL, group_name: str = IMPORT_GROUP) -> DataFrame:
    """Initial status of each detection data row from import audit rows ('+', or '~' without changed fields).

    old = IMPORTED × 3; new = recorded status or default; one row per (detection data, old status), the latest history
    id first, ties broken by detection id, parcel id (NULLs last), then the new status. ``versions``: ``scoped_versions``.
    """
    imports = hist_data.where((F.col("history_type") == "+") | ((F.col("history_type") == "~") & F.col("changed_fields").isNull()))
    d = _audited(imports, versions)
    pres = F.col("detection_prescription_status")
    auto_true = F.col("auto_prescribed").eqNullSafe(F.lit(True))
    d = d.select(
        "detection_id", "detection_data_id", "history_id", "history_date", "parcel_id",
        F.lit(email).alias("email"), F.lit(group_name).alias("group_name"), "changed_fields",
        F.lit(IMPORTED).alias("old_pre_status"), F.lit(IMPORTED).alias("old_val_status"), F.lit(IMPORTED).alias("old_ctl_status"),
        F.when(pres.isNull() & ~auto_true, "NOT_PRESCRIBED").when(pres.isNull() & auto_true, "PRESCRIBED").otherwise(pres).alias("new_pre_status"),
        F.coalesce("detection_validation_status", F.lit("DETECTED_NOT_VERIFIED")).alias("new_val_status"),
        F.coalesce("detection_control_status", F.lit("NOT_CONTROLLED")).alias("new_ctl_status"),
    )
    d = d.withColumn("old_status", _status(F.col("old_val_status"), F.col("old_ctl_status"), F.col("old_pre_status"))).withColumn(
        "new_status", _status(F.col("new_val_status"), F.col("new_ctl_status"), F.col("new_pre_status"))
    )
    w = Window.partitionBy("detection_data_id", "old_status").orderBy(
        F.col("history_id").desc(), F.col("detection_id").asc(), F.col("parcel_id").asc_nulls_last(), F.col("new_status").asc()
    )
    return d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def review_changes(hist_data: DataFrame, versions: DataFrame, users: DataFrame, detection_id: int | None = None) -> DataFrame:
    """One row per audited status change of ``versions`` (``scoped_versions``).

    Keeps one row per (detection, data, history) preferring the highest parcel id with NULL first; reads the old value
    of each status field from the JSON change list (absent or JSON null → the recorded new value); ``old_status`` /
    ``new_status`` are the dotted composites, NULL when a part is NULL. ``detection_id`` optionally restricts to one
    detection (the reference's debug filter, off by default).
    """
    d = _audited(hist_data.where(F.col("changed_fields").isNotNull()), versions)
    d = d.join(users.select(F.col("id").alias("history_user_id"), "email", "group_name"), "history_user_id")
    if detection_id is not None:
        d = d.where(F.col("detection_id") == detection_id)
    w = Window.partitionBy("detection_id", "detection_data_id", "history_id").orderBy(F.col("parcel_id").desc_nulls_first())
    d = d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    changes = F.filter(F.from_json("changed_fields", CHANGE_SCHEMA), lambda e: e["field"].isin(*STATUS_FIELDS))
    d = d.withColumn("_ch", changes).where(F.size("_ch") > 0)

    def old(field: str) -> Column:
        return F.try_element_at(F.filter("_ch", lambda e: e["field"] == field), F.lit(1))["old_value"]

    new_val, new_ctl, new_pre = F.col("detection_validation_status"), F.col("detection_control_status"), F.col("detection_prescription_status")
    out = d.select(
        "detection_id", "detection_data_id", "history_id", "history_date", "parcel_id", "email", "group_name",
        F.to_json(
            F.transform("_ch", lambda e: F.struct(e["field"].alias("field"), e["old_value"].alias("old"), e["new_value"].alias("new"))),
            {"ignoreNullFields": "false"},
        ).alias("fields"),
        new_val.alias("new_val_status"), new_ctl.alias("new_ctl_status"), new_pre.alias("new_pre_status"),
        F.coalesce(old(STATUS_FIELDS[0]), new_val).alias("old_val_status"),
        F.coalesce(old(STATUS_FIELDS[1]), new_ctl).alias("old_ctl_status"),
        F.coalesce(old(STATUS_FIELDS[2]), new_pre).alias("old_pre_status"),
    )
    return out.withColumn("old_status", _status(F.col("old_val_status"), F.col("old_ctl_status"), F.col("old_pre_status"))).withColumn(
        "new_status", _status(F.col("new_val_status"), F.col("new_ctl_status"), F.col("new_pre_status"))
    )


FLOW_COLUMNS = ["detection_id", "detection_data_id", "old_status", "new_status", "source_step", "target_step", "history_date", "parcel_id"]


def status_flow(baseline: DataFrame, changes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Composite statuses mapped to step codes; unmapped and self transitions dropped; app and import rows are
    tagged with ``process`` and UNION-ed distinct."""
    m = mapping

    def mapped(df, process):
        return (
            df.join(m.select(F.col("status_code").alias("old_status"), F.col("step_code").alias("source_step")), "old_status")
            .join(m.select(F.col("status_code").alias("new_status"), F.col("step_code").alias("target_step")), "new_status")
            .where(F.col("source_step") != F.col("target_step"))
            .select(*FLOW_COLUMNS, F.lit(process).alias("process"))
        )

    return mapped(changes, "app").unionByName(mapped(baseline, "import")).distinct()


def transition_code(source: Column, target: Column) -> Column:
    return F.concat(source, F.lit("_"), target)


def unknown_transitions(flow: DataFrame, allowed: DataFrame, by: list[str], labels: tuple[str, ...] = ()) -> DataFrame:
    """W5 (conformance): observed transitions absent from the allowed graph, counted per (code, *by); NULL keys dropped.

    ``labels``: those of ``by`` that are grouped as labels (``label_key``); a group goes by the least of its spellings.
    """
    allowed_codes = allowed.select(transition_code(F.col("from_step"), F.col("to_step")).alias("transition_code"))
    f = flow.withColumn("transition_code", transition_code(F.col("source_step"), F.col("target_step")))
    unknown = f.join(allowed_codes, "transition_code", "left_anti")
    keys = ["transition_code", *by]
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    grouped = [label_key(F.col(k)).alias(f"_key_{k}") if k in labels else F.col(k) for k in keys]
    out = unknown.where(cond).groupBy(*grouped).agg(F.count(F.lit(1)).alias("nb_transitions"), *[F.min(k).alias(k) for k in labels])
    return out.select(*keys, "nb_transitions")


def transition_flow(flow: DataFrame, steps: DataFrame, allowed: DataFrame, strict: bool = True) -> DataFrame:
    """Flow-chart links (code, source_step, target_step, nb_transitions, source, target node ordinals).

    strict keeps allowed transitions only; NULL keys are dropped; links whose target node is unknown are dropped, an
    unknown source node is kept with a NULL ordinal."""
    f = flow.withColumn("transition_code", transition_code(F.col("source_step"), F.col("target_step")))
    if strict:
        codes = allowed.select(transition_code(F.col("from_step"), F.col("to_step")).alias("transition_code"))
        f = f.join(codes, "transition_code", "left_semi")
    keys = ["transition_code", "source_step", "target_step"]
    g = f.where(F.col("transition_code").isNotNull() & F.col("source_step").isNotNull() & F.col("target_step").isNotNull()) \
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("nb_transitions"))
    st = steps.select("step_code", "ordinal")
    g = g.join(st.select(F.col("step_code").alias("target_step"), F.col("ordinal").alias("target")), "target_step", "left")
    g = g.join(st.select(F.col("step_code").alias("source_step"), F.col("ordinal").alias("source")), "source_step", "left")
    return g.where(F.col("target").isNotNull()).select(*keys, "nb_transitions", "target", "source")
