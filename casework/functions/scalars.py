"""Scalar Column functions: numbers, dates, levels, classes.

All are native expressions (``when`` chains, literal maps, ``try_*`` casts);
nothing here leaves the JVM.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from casework.functions import rules
from casework.functions.identity import is_valid_id


def literal_map(d: dict) -> Column:
    """A ``MAP`` literal for in-codegen lookups of small fixed dictionaries."""
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))


def lookup(d: dict, key: Column) -> Column:
    return F.try_element_at(literal_map(d), key)


# -- numbers ----------------------------------------------------------------

# what counts as a number; a plain cast also takes the type suffixes of literals ('12d', '0f')
NUMBER = r"(?i)^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?$|^[+-]?inf(inity)?$"


def to_district(c: Column) -> Column:
    """text or number -> double; comma decimal; bad, NaN -> null."""
    text = F.replace(F.trim(c.cast("string")), F.lit(","), F.lit("."))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))  # the pattern takes no NaN


def to_coordinate(c: Column) -> Column:
    return to_district(c)


def associated_id_is_zero(c: Column) -> Column:
    """P07 predicate: numeric(associated id) with bad/null/NaN -> 0, keep == 0."""
    return F.coalesce(to_district(c), F.lit(0.0)) == 0.0


def district_key(c: Column) -> Column:
    """1.5 -> '1.5'; other values truncate to int text (14.5 -> '14')."""
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c == 1.5, F.lit("1.5"))
            .otherwise(c.cast("int").cast("string")))


def is_target_district(c: Column, target: float) -> Column:
    """Float equality with string fallbacks for two named sub-zones."""
    v = to_district(c)
    named = {14.5: "PALERMO NORTE", 13.5: "BELGRANO"}
    cond = v == F.lit(float(target))
    if target in named:
        cond = F.when(v.isNull(), F.upper(c.cast("string")) == named[target]).otherwise(cond)
    return F.coalesce(cond, F.lit(False))


# -- dates ------------------------------------------------------------------

def to_timestamp_lenient(c: Column) -> Column:
    """coerce to timestamp, unparsable -> null."""
    return F.try_to_timestamp(c.cast("string"))


def to_wall_clock(c: Column, day_first: bool = False) -> Column:
    """F07 for landing texts: ISO, else numbered dates parted by ``/``, ``-``
    or ``.`` with the year last (month first unless ``day_first``; a date that
    doesn't exist that way round is read the other way), with or without a
    time; null otherwise.  Timestamps without zone, whatever the session's."""
    text = F.trim(c)
    numbered = r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})"
    orders = ["$3-$2-$1", "$3-$1-$2"] if day_first else ["$3-$1-$2", "$3-$2-$1"]
    return F.coalesce(text.try_cast("timestamp_ntz"),
                      *[F.regexp_replace(text, numbered, o).try_cast("timestamp_ntz") for o in orders])


def week_start(ts: Column) -> Column:
    """Monday of the ISO week as a DATE."""
    return F.date_trunc("week", ts).cast("date")


def week_label(week: Column, style: str = "dm") -> Column:
    """'dd/MM', 'dd MMM' (title case) or ISO."""
    if style == "dm":
        return F.date_format(week, "dd/MM")
    if style == "dmon":
        return F.initcap(F.date_format(week, "dd MMM"))
    return F.date_format(week, "yyyy-MM-dd")


# -- levels and classes -----------------------------------------------------

def contact_level(category: Column) -> Column:
    """category -> contact level, 'Sin dato' for null/blank/sin_match/unknown."""
    return F.coalesce(lookup(rules.CONTACT_LEVEL_BY_CATEGORY, F.trim(category)), F.lit("Sin dato"))


def contact_and_data(category: Column) -> Column:
    """struct(contacto, brinda_datos)."""
    def pair(a: str, b: str) -> Column:
        return F.struct(F.lit(a).alias("contacto"), F.lit(b).alias("brinda_datos"))
    return (F.when(category.isin(rules.CONTACT_GIVES_DATA), pair("Contacta", "Brinda datos"))
            .when(category.isin(rules.CONTACT_NO_DATA), pair("Contacta", "No brinda datos"))
            .when(category.isin(rules.NO_CONTACT), pair("No se contacta", ""))
            .when(category == "19. Sin cubrir", pair("Sin cubrir", ""))
            .when(category == "20. Desestimado", pair("Desestimado", ""))
            .otherwise(pair("Derivaciones/seguimientos", "")))


def _in_priority(district: Column) -> Column:
    return F.coalesce(district.isin(rules.PRIORITY_DISTRICTS), F.lit(False))


def report_level(level: Column, category: Column, state: Column, district: Column,
                 outcome_text: Column) -> Column:
    """F11 (weekly report): state compared upper+trim."""
    st = F.coalesce(F.upper(F.trim(state)), F.lit(""))
    cat = F.coalesce(F.trim(category), F.lit(""))
    lvl = F.coalesce(F.trim(level), F.lit(""))
    return (F.when((st == "PENDIENTE") & ~_in_priority(district), F.lit("Sin cubrir"))
            .when((st == "CERRADO") & outcome_text.isNull() & cat.isin("sin_match", ""), F.lit("Sin cubrir"))
            .when(lvl.isin("Se contacta", "No se contacta", "Sin cubrir", "Desestimado"), lvl)
            .otherwise(F.lit("Seguimiento")))


def dashboard_contact_class(level: Column, category: Column, state: Column, district: Column,
                            outcome_text: Column, result_text: Column) -> Column:
    """F12 (dashboard): state compared exactly; 'Desestimado' folds into
    'No se contacta'; free-text fallback on ``resultado``."""
    cat = F.coalesce(F.trim(category), F.lit(""))
    lvl = F.coalesce(F.trim(level), F.lit(""))
    res = F.lower(F.coalesce(result_text, F.lit("")))
    return (F.when((state == "PENDIENTE") & ~_in_priority(district), F.lit("Sin cubrir"))
            .when((state == "CERRADO") & cat.isin("sin_match", "") & outcome_text.isNull(), F.lit("Sin cubrir"))
            .when(lvl == "Se contacta", F.lit("Se contacta"))
            .when(lvl.isin("No se contacta", "Desestimado"), F.lit("No se contacta"))
            .when(lvl == "Sin cubrir", F.lit("Sin cubrir"))
            .when(res.contains("no se contacta") | res.contains("no se observan") | res.contains("desestimado"),
                  F.lit("No se contacta"))
            .when(res.contains("sin cubrir"), F.lit("Sin cubrir"))
            .otherwise(F.lit("Sin dato")))


def interview_class(category: Column, id_category: Column) -> Column:
    """F13."""
    cat = F.coalesce(F.trim(category), F.lit(""))
    return (F.when(cat.isin(rules.INTERVIEW_CATEGORIES),
                   F.when(is_valid_id(id_category), F.lit("Brinda DNI")).otherwise(F.lit("No brinda")))
            .otherwise(F.lit("No realiza entrevista")))


def outcome_bucket(category: Column) -> Column:
    """F14."""
    return F.coalesce(lookup(rules.BUCKET_BY_CATEGORY, F.trim(category)), F.lit(rules.BUCKET_DEFAULT))


def origin_group(origin: Column) -> Column:
    """null -> 'Sin origen'; excluded -> marker; unknown -> 'Otro (<value>)'."""
    s = F.upper(F.trim(origin))
    return (F.when(origin.isNull(), F.lit(rules.ORIGIN_NULL_GROUP))
            .when(s.isin(rules.ORIGIN_EXCLUDED), F.lit(rules.ORIGIN_EXCLUDED_MARK))
            .otherwise(F.coalesce(lookup(rules.ORIGIN_GROUP, s),
                                  F.concat(F.lit("Otro ("), F.trim(origin), F.lit(")")))))


def manual_group(origin: Column) -> Column:
    """F16."""
    return F.coalesce(lookup(rules.MANUAL_GROUP, F.upper(F.trim(origin))), F.lit(rules.MANUAL_GROUP_DEFAULT))


def card_type(c: Column) -> Column:
    """F18."""
    return F.upper(F.trim(c))


def pct_of_total(n: Column, total: Column) -> Column:
    """round-half-even percent of a (zero -> 1) total, as int."""
    return F.bround(F.lit(100.0) * n / F.greatest(total, F.lit(1)), 0).cast("int")


def pct_cell(n: Column, total: Column) -> Column:
    """'<p>% (<n>)'."""
    return F.format_string("%d%% (%d)", pct_of_total(n, total), n)


def pct_of_parent(n: Column, parent: Column) -> Column:
    """half-up percent of the parent row; null when n = 0 or no parent."""
    return (F.when((n == 0) | parent.isNull() | (parent == 0), F.lit(None).cast("int"))
            .otherwise(F.floor(n * F.lit(100.0) / parent + F.lit(0.5)).cast("int")))
