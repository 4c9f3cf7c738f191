"""Report datasets (R01-R10, A08-A13, L02, F19-F22) as aggregation plans.

One GROUPING SETS aggregation replaces the source's masked scan per
(row x zone x class).  Zones that the source repeats (per district, rest,
city total) are disjoint labels plus a rolled-up total, so every row is
aggregated once per grouping set.  Week axes (last N *observed* weeks) are
scalar subqueries; zero-filled spines are built by exploding fixed literal
arrays onto the (bounded) week list - never by joining data with data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.functions import rules
from casework.functions.scalars import (associated_id_is_zero, card_type, dashboard_contact_class,
                                        district_key, interview_class, manual_group, origin_group,
                                        outcome_bucket, pct_of_parent, pct_of_total,
                                        report_level, to_timestamp_lenient, week_start)
from casework.operators.dedup import keep_first_per_key

WEEK = "semana"
PARTITION = "week"  # Monday week, the partition column of the stored history


# -- week axis (L02, A08) ------------------------------------------------------

def last_weeks(df: DataFrame, n: int = rules.REPORT_WEEKS, week: str = WEEK) -> DataFrame:
    """The last ``n`` distinct observed weeks (a top-n: bounded by n)."""
    return df.select(week).distinct().orderBy(F.desc(week)).limit(n)


def first_of_last_weeks(df: DataFrame, n: int = rules.REPORT_WEEKS, week: str = WEEK) -> Column:
    """Scalar: the oldest of the last ``n`` observed weeks."""
    return last_weeks(df, n, week).agg(F.min(week)).scalar()


def week_range(df: DataFrame, start: Column, end: Column, week: str = WEEK) -> DataFrame:
    """Keep weeks with start <= week <= end."""
    return df.filter(F.col(week).between(start, end))


def spine(weeks: DataFrame, **dims: list) -> DataFrame:
    """Week list x fixed label lists, by exploding literal arrays."""
    out = weeks
    for name, values in dims.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def reindex_counts(counts: DataFrame, spine_df: DataFrame, keys: list[str], value: str = "n") -> DataFrame:
    """Left join onto the spine, missing cells -> 0."""
    return (spine_df.join(counts, keys, "left")
                    .withColumn(value, F.coalesce(F.col(value), F.lit(0)).cast("bigint")))


# -- preparation (R09, R10) ------------------------------------------------------

def _week_column(df: DataFrame) -> Column:
    """The Monday week: the partition column of a stored history (so that
    filters on weeks prune its partitions), else computed from the date."""
    return F.col(PARTITION).cast("date") if PARTITION in df.columns else week_start(F.col("fecha_inicio"))


def prepare_weekly(df: DataFrame, dedup_incident: bool = False) -> DataFrame:
    """Date, P07, F15 + P08, F16, F11, P10, W09, F18, F17 (order matters:
    the report level is computed before the category exclusion)."""
    out = (df.withColumn("fecha_inicio", to_timestamp_lenient(F.col("fecha_inicio")))
             .filter(F.col("fecha_inicio").isNotNull())
             .withColumn(WEEK, _week_column(df))
             .filter(associated_id_is_zero(F.col("id_suceso_asociado")))
             .withColumn("grupo_origen", origin_group(F.col("origen")))
             .filter(F.col("grupo_origen") != rules.ORIGIN_EXCLUDED_MARK)
             .withColumn("grupo_manual", manual_group(F.col("origen")))
             .withColumn("nivel_norm", report_level(F.col("nivel_contacto"), F.col("categoria_final"),
                                                    F.col("estado"), F.col("comuna_calculada"),
                                                    F.col("cierre_texto"))))
    cat = F.col("categoria_final")
    excluded = (F.coalesce(cat.isin("error de soflex", "POSITIVO", "DERIVACION A RED"), F.lit(False))
                | (F.coalesce(cat == "sin_match", F.lit(False)) & (F.col("nivel_norm") != "Sin cubrir")))
    out = out.filter(~excluded)
    if dedup_incident:
        out = keep_first_per_key(out, ["id_suceso"], ["fecha_inicio", "_seq"])
    return out.withColumns({"tipo_carta_norm": card_type(F.col("tipo_carta")),
                            "comuna_key": district_key(F.col("comuna_calculada"))})


def prepare_dashboard(df: DataFrame) -> DataFrame:
    """P06, P07, exact-match P08, P09 (null categories kept)."""
    cat = F.col("categoria_final")
    return (df.withColumn("fecha_inicio", to_timestamp_lenient(F.col("fecha_inicio")))
              .filter(F.col("fecha_inicio").isNotNull())
              .withColumn(WEEK, _week_column(df))
              .filter(associated_id_is_zero(F.col("id_suceso_asociado")))
              .filter(~F.coalesce(F.col("origen").isin("CORTAN", "EQUIVOCADO"), F.lit(False)))
              .filter(~F.coalesce(cat.isin("sin_match", "error de soflex"), F.lit(False))))


# -- zones ---------------------------------------------------------------------

def dashboard_zone(district: Column) -> Column:
    """Disjoint dashboard zones; their union is the city total."""
    return (F.when(district == 2.0, F.lit("c2")).when(district == 13.0, F.lit("c13"))
             .when(district == 14.0, F.lit("c14")).when(district == 1.5, F.lit("zona1a"))
             .otherwise(F.lit("resto")))


def report_zone(key: Column) -> Column:
    """Highlighted district keys, everything else (null too) is 'resto'."""
    return F.when(key.isin(rules.HIGHLIGHT_DISTRICT_KEYS), key).otherwise(F.lit("resto"))


# -- weekly hierarchical table (A11, A12, R06, F21) -----------------------------

FINE = ["zone", WEEK, "grupo_manual", "nivel_norm"]


def fine_counts(prepared: DataFrame) -> DataFrame:
    """Counts by zone, week, group and level: all that the weekly table rolls
    up.  A week's counts come from the rows of that week alone, so they can be
    kept and replaced by week."""
    return prepared.withColumn("zone", report_zone(F.col("comuna_key"))).groupBy(*FINE).agg(F.count(F.lit(1)).alias("n"))


def hierarchy_counts(prepared: DataFrame) -> DataFrame:
    """Counts for total / level / group / group x level rows, per week, per
    zone and for the whole city."""
    return roll_up(fine_counts(prepared))


def roll_up(fine: DataFrame) -> DataFrame:
    """``fine_counts`` (just made, or kept) rolled up by grouping sets, over
    some hundred sums a week and not over rows.  Only the four displayed groups
    produce group rows ('Otros' still counts in the totals).  Cells that would
    be zero are absent."""
    z, w, g, lv = FINE
    agg = (fine.groupingSets([[z, w], [z, w, lv], [z, w, g], [z, w, g, lv], [w], [w, lv], [w, g], [w, g, lv]],
                             z, w, g, lv)
           .agg(F.sum("n").alias("n"),
                (F.grouping(z) * 4 + F.grouping(g) * 2 + F.grouping(lv)).alias("_gid")))
    gz = F.col("_gid").bitwiseAND(4) != 0
    gg = F.col("_gid").bitwiseAND(2) != 0
    gl = F.col("_gid").bitwiseAND(1) != 0
    row_type = (F.when(gg & gl, F.lit("total")).when(gg, F.lit("total_nivel"))
                 .when(gl, F.lit("grupo_origen")).otherwise(F.lit("grupo_origen_nivel")))
    out = (agg.withColumn("zone", F.when(gz, F.lit("todas")).otherwise(F.col(z)))
              .withColumn("row_type", row_type)
              .withColumn("grupo", F.when(gg, F.lit(None).cast("string")).otherwise(F.col(g)))
              .withColumn("nivel", F.when(gl, F.lit(None).cast("string")).otherwise(F.col(lv)))
              .filter(F.col("grupo").isNull() | F.col("grupo").isin(rules.MANUAL_GROUP_ORDER))
              .select("zone", WEEK, "row_type", "grupo", "nivel", F.col("n").cast("bigint").alias("n")))
    return out


def display_order(row_type: Column, group: Column, level: Column) -> Column:
    """Table order - total, its levels (fixed level order), then each
    displayed group (fixed group order) followed by its levels."""
    from casework.functions.scalars import lookup
    li = lookup({v: i for i, v in enumerate(rules.LEVEL_ORDER)}, level)
    gi = lookup({v: i for i, v in enumerate(rules.MANUAL_GROUP_ORDER)}, group)
    return (F.when(row_type == "total", F.lit(0))
             .when(row_type == "total_nivel", 1 + li)
             .when(row_type == "grupo_origen", 10 + 10 * gi)
             .otherwise(10 + 10 * gi + 1 + li))


def _row_keys() -> Column:
    """Every row key the table can have (fixed vocabulary: 30 keys)."""
    def key(t: str, g: str | None, lv: str | None) -> Column:
        return F.struct(F.lit(t).alias("row_type"), F.lit(g).cast("string").alias("grupo"),
                        F.lit(lv).cast("string").alias("nivel"))
    keys = [key("total", None, None)] + [key("total_nivel", None, lv) for lv in rules.LEVEL_ORDER]
    for g in rules.MANUAL_GROUP_ORDER:
        keys += [key("grupo_origen", g, None)] + [key("grupo_origen_nivel", g, lv) for lv in rules.LEVEL_ORDER]
    return F.explode(F.array(*keys))


def hierarchy_with_pct(prepared: DataFrame) -> DataFrame:
    """R06 + F21 + L04: the weekly table in long form, zero-filled like the
    source (rows whose key occurs anywhere in the base, every observed week,
    'todas', 'resto' and each highlighted district with rows), each cell with
    its percent of the parent row (total for level/group rows, the group row
    for group x level rows; half-up) and its display order.

    The grouping-sets aggregation is consumed once: the (week, zone) axis
    comes from one light distinct pass, and key presence and parent totals
    are window flags over the small zero-filled table (no self-joins, which
    would re-run the aggregation)."""
    h = hierarchy_counts(prepared)
    fixed_zones = ["todas", "resto"]
    wz = prepared.select(WEEK, report_zone(F.col("comuna_key")).alias("zone")).distinct()
    weeks = wz.select(WEEK).distinct()
    sp = spine(weeks, zone=fixed_zones + rules.HIGHLIGHT_DISTRICT_KEYS)
    sp = sp.filter(F.col("zone").isin(fixed_zones)).unionByName(
        sp.filter(~F.col("zone").isin(fixed_zones)).join(wz.select("zone").distinct(), "zone", "left_semi"))
    sp = sp.withColumn("_k", _row_keys()).select("zone", WEEK, "_k.*")
    full = (sp.alias("s").join(h.alias("c"),
                               (F.col("s.zone") == F.col("c.zone")) & (F.col(f"s.{WEEK}") == F.col(f"c.{WEEK}"))
                               & (F.col("s.row_type") == F.col("c.row_type"))
                               & F.col("s.grupo").eqNullSafe(F.col("c.grupo"))
                               & F.col("s.nivel").eqNullSafe(F.col("c.nivel")), "left")
                .select("s.*", F.coalesce(F.col("c.n"), F.lit(0)).cast("bigint").alias("n")))
    by_key = Window.partitionBy("row_type", "grupo", "nivel")
    by_cell = Window.partitionBy("zone", WEEK)
    by_group = Window.partitionBy("zone", WEEK, "grupo")
    present = F.max(((F.col("zone") == "todas") & (F.col("n") > 0)).cast("int")).over(by_key) == 1
    total_n = F.max(F.when(F.col("row_type") == "total", F.col("n"))).over(by_cell)
    group_n = F.max(F.when(F.col("row_type") == "grupo_origen", F.col("n"))).over(by_group)
    parent_n = (F.when(F.col("row_type").isin("total_nivel", "grupo_origen"), total_n)
                 .when(F.col("row_type") == "grupo_origen_nivel", group_n))
    return (full.withColumn("_present", present).filter("_present")
                .select("zone", WEEK, "row_type", "grupo", "nivel", "n",
                        pct_of_parent(F.col("n"), parent_n).alias("pct"),
                        display_order(F.col("row_type"), F.col("grupo"), F.col("nivel")).alias("row_order")))


# -- dashboard KPI table (R01, F19, F20) -------------------------------------------

def kpi_table(base: DataFrame, n_weeks: int = rules.REPORT_WEEKS) -> DataFrame:
    """Six KPI rows x last ``n_weeks`` weeks of the whole base x six
    zones.  Percent rows use all contact classes of AUTOMATICA rows of the
    week as denominator (zero -> 1), half-even rounding."""
    wmin = first_of_last_weeks(base, n_weeks)
    cls = dashboard_contact_class(F.col("nivel_contacto"), F.col("categoria_final"), F.col("estado"),
                                  F.col("comuna_calculada"), F.col("cierre_texto"), F.col("resultado"))
    auto = F.col("tipo_carta") == "AUTOMATICA"
    d = (base.filter(F.col(WEEK) >= wmin)
             .withColumn("zone", dashboard_zone(F.col("comuna_calculada")))
             .withColumn("_cls", cls))

    def cnt(cond: Column) -> Column:
        return F.count_if(F.coalesce(cond, F.lit(False)))

    agg = (d.groupingSets([["zone", WEEK], [WEEK]], "zone", WEEK)
            .agg(F.count(F.lit(1)).alias("total"),
                 cnt(F.col("categoria_final") == "01. Traslado efectivo a CIS").alias("cis"),
                 cnt(auto).alias("auto"),
                 cnt(auto & (F.col("_cls") == "Se contacta")).alias("se_contacta"),
                 cnt(auto & (F.col("_cls") == "No se contacta")).alias("no_se_contacta"),
                 cnt(auto & (F.col("_cls") == "Sin cubrir")).alias("sin_cubrir"),
                 F.grouping("zone").alias("_gz"))
            .withColumn("zone", F.when(F.col("_gz") == 1, F.lit("total")).otherwise(F.col("zone"))))
    weeks = last_weeks(base, n_weeks)
    sp = spine(weeks, zone=["c2", "c13", "c14", "zona1a", "resto", "total"])
    full = reindex_counts(agg.drop("_gz"), sp, [WEEK, "zone"], "total")
    full = full.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
                             for c in ["cis", "auto", "se_contacta", "no_se_contacta", "sin_cubrir"]})
    def row(ord_: int, label: str, n: str, pct: bool) -> Column:
        p = pct_of_total(F.col(n), F.col("auto")) if pct else F.lit(None).cast("int")
        return F.struct(F.lit(ord_).alias("ord"), F.lit(label).alias("kpi"), F.col(n).alias("n"), p.alias("pct"))
    rows = F.array(row(1, rules.KPI_ROWS[0], "total", False), row(2, rules.KPI_ROWS[1], "cis", False),
                   row(3, rules.KPI_ROWS[2], "auto", False), row(4, rules.KPI_ROWS[3], "se_contacta", True),
                   row(5, rules.KPI_ROWS[4], "no_se_contacta", True), row(6, rules.KPI_ROWS[5], "sin_cubrir", True))
    out = full.select("zone", WEEK, F.inline(rows))
    cell = F.when(F.col("pct").isNull(), F.col("n").cast("string")).otherwise(
        F.format_string("%d%% (%d)", F.col("pct"), F.col("n")))
    base_map = {f"{z}|{i + 1}": v for z, vals in rules.KPI_BASELINES.items() for i, v in enumerate(vals)}
    from casework.functions.scalars import lookup, week_label
    baseline = F.coalesce(lookup(base_map, F.concat_ws("|", F.col("zone"), F.col("ord").cast("string"))),
                          F.lit(rules.KPI_BASELINE_DEFAULT))
    return out.select("zone", WEEK, week_label(F.col(WEEK), "dmon").alias("week_label"), "kpi",
                      baseline.alias("base"), "n", "pct", cell.alias("cell"))


# -- per-zone week axes ----------------------------------------------------------------

def zone_tags(zones: dict[str, Column | None]) -> Column:
    """Array of the zone names whose predicate holds (None = every row)."""
    parts = [F.when(F.lit(True) if p is None else F.coalesce(p, F.lit(False)), F.lit(name))
             for name, p in zones.items()]
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def top_weeks_per_zone(tagged: DataFrame, n: int) -> DataFrame:
    """(zone, week) for the last ``n`` observed weeks of each zone: a window
    over the distinct (zone, week) pairs (a handful of rows per zone)."""
    w = Window.partitionBy("zone").orderBy(F.desc(WEEK))
    return (tagged.select("zone", WEEK).distinct()
                  .withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r"))


# -- evolution per zone (R02, R07) ---------------------------------------------------

def dni_evolution(base: DataFrame, zones: dict[str, Column | None], rest_zone: str | None,
                  n_weeks: int = rules.REPORT_WEEKS) -> DataFrame:
    """Distinct (week, id) per evolution class per zone on the last
    ``n_weeks`` weeks.  ``zones`` maps a zone name to a row predicate (None =
    all rows); the week axis is the whole base's, except for ``rest_zone``
    whose axis comes from its own rows.  'Nuevo repetido' counts as 'Nuevos';
    each (zone, week, id) keeps the label of its first row.  A base without
    labels gives zeros.  The axes come from one narrow pass; only the weeks
    from the oldest of them on are labelled, reduced to one row per (week,
    id, zones) and only then spread over the zones."""
    classes = ["Nuevos", "Recurrentes", "Migratorios"]
    evo = F.col("tipo_evolucion") if "tipo_evolucion" in base.columns else F.lit(None).cast("string")
    label = F.when(evo == "Nuevo repetido", F.lit("Nuevos")).otherwise(evo)
    all_tag = "__all__"
    axis_tags = {all_tag: None} | ({rest_zone: zones[rest_zone]} if rest_zone is not None else {})
    tops = top_weeks_per_zone(base.withColumn("zone", F.explode(zone_tags(axis_tags))), n_weeks)
    shared = F.array(*[F.lit(z) for z in zones if z != rest_zone])
    axis = tops.select(F.explode(F.when(F.col("zone") == all_tag, shared).otherwise(F.array("zone"))).alias("zone"), WEEK)
    order = F.struct("fecha_inicio", "_seq")
    first = (base.filter(F.col(WEEK) >= tops.agg(F.min(WEEK)).scalar())
                 .select(WEEK, "dni_categorizado", zone_tags(zones).alias("_zones"), order.alias("_o"), label.alias("_lab"))
                 .groupBy(WEEK, "dni_categorizado", "_zones")
                 .agg(F.min("_o").alias("_o"), F.min_by("_lab", "_o").alias("_lab")))
    per_id = (first.withColumn("zone", F.explode("_zones"))
                   .groupBy("zone", WEEK, "dni_categorizado").agg(F.min_by("_lab", "_o").alias("_lab")))
    counts = (per_id.filter(F.col("_lab").isin(classes))
                    .groupBy("zone", WEEK).pivot("_lab", classes).count())
    out = axis.join(counts, ["zone", WEEK], "left")
    return out.select("zone", WEEK, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c.lower())
                                       for c in classes])


def dashboard_zones() -> dict[str, Column | None]:
    d = F.col("comuna_calculada")
    return {"c2": d == 2.0, "c13": d == 13.0, "c14": d == 14.0, "zona1a": d == 1.5,
            "resto": ~F.coalesce(d.isin(rules.PRIORITY_DISTRICTS), F.lit(False)), "total": None}


def report_zones() -> dict[str, Column | None]:
    d, k = F.col("comuna_calculada"), F.col("comuna_key")
    return {"1.5": d == 1.5, "2": d == 2.0, "12": d == 12.0, "13": d == 13.0, "14": d == 14.0,
            "todas": None, "resto": ~F.coalesce(k.isin(rules.HIGHLIGHT_DISTRICT_KEYS), F.lit(False))}


# -- contact breakdowns (R03, R04, R05, A13) -------------------------------------------

def outcome_breakdown(base: DataFrame, n_weeks: int = rules.REPORT_WEEKS, legacy_names: bool = False) -> DataFrame:
    """R03 (dashboard): contacted rows by outcome bucket per week; each zone
    uses the last weeks of its *own* rows.  ``legacy_names`` reproduces the
    source's stale bucket list (only the default bucket can be non-zero)."""
    buckets = rules.LEGACY_DASHBOARD_BUCKETS if legacy_names else \
        sorted(set(rules.BUCKET_BY_CATEGORY.values())) + [rules.BUCKET_DEFAULT]
    tagged = base.withColumn("zone", F.explode(zone_tags(dashboard_zones())))
    tops = top_weeks_per_zone(tagged, n_weeks)
    counts = (base.filter((F.col(WEEK) >= tops.agg(F.min(WEEK)).scalar()) & (F.col("nivel_contacto") == "Se contacta"))
                  .withColumn("zone", F.explode(zone_tags(dashboard_zones())))
                  .groupBy("zone", WEEK, outcome_bucket(F.col("categoria_final")).alias("bucket"))
                  .agg(F.count(F.lit(1)).alias("n")))
    sp = spine(tops, bucket=buckets)
    return reindex_counts(counts, sp, ["zone", WEEK, "bucket"]).select("zone", WEEK, "bucket", "n")


def _class_pairs() -> Column:
    return F.explode(F.array(
        *[F.struct(F.lit("entrevista").alias("kind"), F.lit(c).alias("clase")) for c in rules.INTERVIEW_CLASSES],
        *[F.struct(F.lit("resultado").alias("kind"), F.lit(c).alias("clase")) for c in rules.OUTCOME_CLASSES]))


def contact_breakdown(prepared: DataFrame, n_weeks: int = rules.REPORT_WEEKS) -> DataFrame:
    """R05 (+A13): contacted rows by interview class and outcome class, per
    card type, week (global last weeks) and zone; card type 'ALL' is the
    AUTO+MANUAL roll-up.  Zero-filled like the source: every (week, card
    type, class) cell for 'todas', 'resto' and each highlighted district
    that has any row."""
    wmin = first_of_last_weeks(prepared, n_weeks)
    zoned = prepared.withColumn("zone", report_zone(F.col("comuna_key")))
    d = (zoned.filter((F.col(WEEK) >= wmin) & (F.col("nivel_contacto") == "Se contacta")
                      & F.col("tipo_carta_norm").isin("AUTOMATICA", "MANUAL"))
              .withColumn("_ent", interview_class(F.col("categoria_final"), F.col("dni_categorizado")))
              .withColumn("_res", outcome_bucket(F.col("categoria_final")))
              # rows are counted by the finest key first; only these sums are doubled and rolled up
              .groupBy("zone", WEEK, F.col("tipo_carta_norm").alias("tipo"), "_ent", "_res").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("_pair", F.explode(F.array(
                  F.struct(F.lit("entrevista").alias("kind"), F.col("_ent").alias("clase")),
                  F.struct(F.lit("resultado").alias("kind"), F.col("_res").alias("clase")))))
              .select("zone", WEEK, "tipo", "_pair.kind", "_pair.clase", "n")
              .filter(F.col("clase").isin(rules.INTERVIEW_CLASSES + rules.OUTCOME_CLASSES)))
    agg = (d.groupingSets([["zone", WEEK, "tipo", "kind", "clase"], ["zone", WEEK, "kind", "clase"],
                           [WEEK, "tipo", "kind", "clase"], [WEEK, "kind", "clase"]],
                          "zone", WEEK, "tipo", "kind", "clase")
             .agg(F.sum("n").alias("n"), (F.grouping("zone") * 2 + F.grouping("tipo")).alias("_g"))
             .withColumn("zone", F.when(F.col("_g").bitwiseAND(2) != 0, F.lit("todas")).otherwise(F.col("zone")))
             .withColumn("tipo", F.when(F.col("_g").bitwiseAND(1) != 0, F.lit("ALL")).otherwise(F.col("tipo")))
             .drop("_g"))
    fixed_zones = ["todas", "resto"]
    sp = (spine(last_weeks(prepared, n_weeks), zone=fixed_zones + rules.HIGHLIGHT_DISTRICT_KEYS,
                tipo=["AUTOMATICA", "MANUAL", "ALL"])
          .withColumn("_kc", _class_pairs()).select("zone", WEEK, "tipo", "_kc.kind", "_kc.clase"))
    present = zoned.select("zone").distinct()
    sp = sp.filter(F.col("zone").isin(fixed_zones)).unionByName(
        sp.filter(~F.col("zone").isin(fixed_zones)).join(present, "zone", "left_semi"))
    return reindex_counts(agg, sp, ["zone", WEEK, "tipo", "kind", "clase"]).select(
        "zone", WEEK, "tipo", "kind", "clase", "n")


def contact_breakdown_dashboard(base: DataFrame, n_weeks: int = rules.REPORT_WEEKS) -> DataFrame:
    """R04 (dashboard copy): contacted rows by interview and outcome class per
    card type (compared exactly, no trim/upper) and week of the base's last
    weeks; city-wide, no zones."""
    wmin = first_of_last_weeks(base, n_weeks)
    d = (base.filter((F.col(WEEK) >= wmin) & (F.col("nivel_contacto") == "Se contacta")
                     & F.col("tipo_carta").isin("AUTOMATICA", "MANUAL"))
             .withColumn("_pair", F.explode(F.array(
                 F.struct(F.lit("entrevista").alias("kind"),
                          interview_class(F.col("categoria_final"), F.col("dni_categorizado")).alias("clase")),
                 F.struct(F.lit("resultado").alias("kind"), outcome_bucket(F.col("categoria_final")).alias("clase")))))
             .select(WEEK, F.col("tipo_carta").alias("tipo"), "_pair.kind", "_pair.clase"))
    counts = d.groupBy(WEEK, "tipo", "kind", "clase").agg(F.count(F.lit(1)).alias("n"))
    sp = (spine(last_weeks(base, n_weeks), tipo=["AUTOMATICA", "MANUAL"])
          .withColumn("_kc", F.explode(F.array(
              *[F.struct(F.lit("entrevista").alias("kind"), F.lit(c).alias("clase")) for c in rules.INTERVIEW_CLASSES],
              *[F.struct(F.lit("resultado").alias("kind"), F.lit(c).alias("clase")) for c in rules.OUTCOME_CLASSES])))
          .select(WEEK, "tipo", "_kc.kind", "_kc.clase"))
    return reindex_counts(counts, sp, [WEEK, "tipo", "kind", "clase"]).select(WEEK, "tipo", "kind", "clase", "n")


# -- JSON payload (R08) --------------------------------------------------------------

def chart_payload(evolution: DataFrame, label_format: str = "dd MMM") -> DataFrame:
    """One JSON document per zone with week labels and the three
    evolution series (label, data, colour); ``dd MMM`` for the dashboard,
    ``dd/MM`` for the weekly report."""
    pts = F.array_sort(F.collect_list(F.struct(WEEK, "nuevos", "recurrentes", "migratorios")))
    g = evolution.groupBy("zone").agg(pts.alias("_p"))
    labels = F.transform("_p", lambda p: F.date_format(p[WEEK], label_format))

    def ds(name: str, colour: str) -> Column:
        field = name.lower()
        return F.struct(F.lit(name).alias("label"), F.transform("_p", lambda p: p[field]).alias("data"),
                        F.lit(colour).alias("backgroundColor"))
    payload = F.struct(labels.alias("labels"),
                       F.array(*[ds(n, c) for n, c in rules.EVOLUTION_SERIES]).alias("datasets"))
    return g.select("zone", F.to_json(payload).alias("payload"))
