"""National-id categoriser (F03) and valid-id predicate.

F03 is one ordered ``when`` chain producing ``struct(category, reason)``.
Mode ``parity`` reproduces the source patterns literally: they were written
as raw strings with doubled backslashes, so ``\\\\s*`` means "a literal
backslash then zero or more ``s``" and most alternatives can only fire on
text containing a backslash.  Mode ``intended`` uses the obvious whitespace
patterns instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions import rules
from casework.functions.text import strip_blanks

# ---------------------------------------------------------------------------
# FIXED VALUES: id patterns exactly as the source system wrote them.  Java
# and Python regex syntax agree on every construct used here.
# ---------------------------------------------------------------------------
FOREIGN_PATTERN_PARITY = (
    r"(extranjero|paraguay|venezol|colombian|uruguay|brasil|chilen|peruano|mexican|"
    r"espaol|dominican|dominicana|pasaporte|c\\.?d\\.?[ie]:?|rnm|cedula|ciudadano\\s+extranjero)"
)
NOT_GIVEN_PATTERN_PARITY = (
    r"(no\\s*brind|no\\s*bri[nm]d|no\\s*aporta|no\\s*aporto|no\\s*indica|no\\s*sabe|"
    r"no\\s*recuerda|no\\s*recuerd|no\\s*tiene|nunca\\s*tuvo|sin\\s*dni|sin\\s*dato|"
    r"sin\\s*inform|ilegible|invisible|no\\s*visible|exhib|no\\s*lo\\s*sabe|menor\\s*de\\s*edad)"
)
SYMBOLS_PATTERN_PARITY = r"^[xX\\*\\-\\.]+$"
SHORT_LETTERS_PATTERN = r"^[A-Za-z]{1,3}$"
ONLY_LETTERS_PATTERN = r"^[A-Za-z]+$"
# end of FIXED VALUES


def _intended(p: str) -> str:
    """The patterns the source meant to write (single backslashes)."""
    return p.replace("\\\\", "\\")


def _patterns(mode: str) -> tuple[str, str, str]:
    if mode == "parity":
        return FOREIGN_PATTERN_PARITY, NOT_GIVEN_PATTERN_PARITY, SYMBOLS_PATTERN_PARITY
    if mode == "intended":
        return (_intended(FOREIGN_PATTERN_PARITY), _intended(NOT_GIVEN_PATTERN_PARITY),
                _intended(SYMBOLS_PATTERN_PARITY))
    raise ValueError(f"unknown mode {mode!r}")


def id_helpers(raw: Column) -> dict[str, Column]:
    """Per-row intermediates of F03, to be projected once as columns."""
    s = strip_blanks(raw.cast("string"))
    return {"_id_s": s, "_id_low": F.lower(s), "_id_digits": F.regexp_replace(s, r"\D", "")}


def categorize_id_from(raw: Column, s: Column, low: Column, digits: Column, mode: str = "parity") -> Column:
    """F03 over precomputed intermediates -> struct<category, reason>."""
    foreign, not_given, symbols = _patterns(mode)
    nd = F.length(digits)
    distinct_letters = F.size(F.array_distinct(F.split(low, "")))

    def out(cat: Column | str, reason: str) -> Column:
        c = cat if isinstance(cat, Column) else F.lit(cat)
        return F.struct(c.alias("category"), F.lit(reason).alias("reason"))

    no = rules.NO_ID
    return (
        F.when(raw.isNull(), out(no, "nan"))
        .when(s == "", out(no, "empty"))
        # digits alone match no pattern below
        .when((s == digits) & (nd >= 6) & (nd <= 10), out(digits.cast("bigint").cast("string"), "dni_valido"))
        # the source matched case-insensitively; ``low`` is already lower case, the pattern letters are
        # lower-case ASCII and the symbol class lists x and X, so plain matching gives the same result
        .when(low.rlike(not_given), out(no, "patron_no_brindo_genericos"))
        .when(s.rlike(symbols) | s.rlike(SHORT_LETTERS_PATTERN), out(no, "simbolos_o_letras_cortas"))
        .when(s.rlike(ONLY_LETTERS_PATTERN) & (distinct_letters <= 2), out(no, "solo_letras_repetidas"))
        .when(low.rlike(foreign), out(rules.FOREIGN_ID, "patron_extranjero"))
        .when((nd >= 6) & (nd <= 10), out(digits.cast("bigint").cast("string"), "dni_valido"))
        .when((nd < 6) | low.rlike("[A-Za-z]"), out(no, "texto_o_corto"))
        .otherwise(out(no, "resto_no_brindo"))
    )


def categorize_id(raw: Column, mode: str = "parity") -> Column:
    """F03 as a single Column expression (ad-hoc use; inside a pipeline use
    ``with_id_category`` so the intermediates are computed once per row)."""
    h = id_helpers(raw)
    return categorize_id_from(raw, h["_id_s"], h["_id_low"], h["_id_digits"], mode)


def with_id_category(df: DataFrame, src: str, out_cat: str, out_reason: str, mode: str = "parity") -> DataFrame:
    """F03 as a DataFrame step: intermediates projected once, then the chain."""
    h = id_helpers(F.col(src))
    staged = df.select("*", *[v.alias(k) for k, v in h.items()])
    cat = categorize_id_from(F.col(src), F.col("_id_s"), F.col("_id_low"), F.col("_id_digits"), mode)
    return (staged.select("*", cat.alias("_id_cat"))
                  .select(*[c for c in df.columns if c not in (out_cat, out_reason)],
                          F.trim(F.col("_id_cat.category")).alias(out_cat),
                          F.col("_id_cat.reason").alias(out_reason)))


def is_valid_id(c: Column) -> Column:
    """length >= 6, not one repeated character, digits only once ``.``
    and ``-`` are removed, not in the invalid list.  Null -> false."""
    s = strip_blanks(c.cast("string"))
    one_char = F.replace(s, F.substring(s, 1, 1), F.lit("")) == ""
    return F.coalesce(
        ~s.isin(rules.INVALID_ID_TEXTS)
        & (F.length(s) >= 6)
        & ~one_char
        & F.regexp_replace(s, r"[.\-]", "").rlike(r"^[0-9]+$"),
        F.lit(False),
    )
