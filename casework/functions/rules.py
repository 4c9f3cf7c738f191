"""Rule tables as data.

Everything between the FIXED VALUES markers must equal the source system's
vocabulary for results to match: category labels, lookup maps, ordered
substring rules, origin groups, placeholder and exclusion lists.  They are
kept in their natural order (order matters for the substring tier and for
display order) and are consumed by the operators as literal maps / `when`
chains / tiny broadcast tables.  No logic lives here.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source system exactly)
# ---------------------------------------------------------------------------

CANONICAL_CATEGORIES = [
    "01. Traslado efectivo a CIS",
    "02. Traslado efectivo a DIPA",
    "03. Traslado efectivo a Micro",
    "05. Traslado efectivo a lugar de origen",
    "06. Acepta CIS pero no hay vacante",
    "07. Se realiza entrevista y se retira del lugar",
    "08. No se realiza entrevista y se retira del lugar",
    "09. Derivación al equipo de Umbral Cero de Primer Abordaje",
    "12. Derivación a SAME por deterioro físico visible",
    "13. Derivación a SAME por salud mental",
    "14. Derivación a Seguridad",
    "15. Derivación a Ordenamiento Urbano",
    "16. No se observan personas y hay pertenencias",
    "17. No se observan personas ni pertenencias",
    "18. Mendicidad",
    "19. Sin cubrir",
    "20. Desestimado",
]

CONTACT_LEVEL_BY_CATEGORY = {
    "01. Traslado efectivo a CIS": "Se contacta",
    "02. Traslado efectivo a DIPA": "Se contacta",
    "03. Traslado efectivo a Micro": "Se contacta",
    "05. Traslado efectivo a lugar de origen": "Se contacta",
    "06. Acepta CIS pero no hay vacante": "Se contacta",
    "07. Se realiza entrevista y se retira del lugar": "Se contacta",
    "08. No se realiza entrevista y se retira del lugar": "Se contacta",
    "09. Derivación al equipo de Umbral Cero de Primer Abordaje": "Se contacta",
    "12. Derivación a SAME por deterioro físico visible": "Se contacta",
    "13. Derivación a SAME por salud mental": "Se contacta",
    "14. Derivación a Seguridad": "Se contacta",
    "15. Derivación a Ordenamiento Urbano": "Se contacta",
    "18. Mendicidad": "Se contacta",
    "16. No se observan personas y hay pertenencias": "No se contacta",
    "17. No se observan personas ni pertenencias": "No se contacta",
    "19. Sin cubrir": "Sin cubrir",
    "20. Desestimado": "Desestimado",
}

BUCKET_BY_CATEGORY = {
    "01. Traslado efectivo a CIS": "DERIVACIÓN A DISPOSITIVO RED",
    "02. Traslado efectivo a DIPA": "DERIVACIÓN A DISPOSITIVO RED",
    "03. Traslado efectivo a Micro": "DERIVACIÓN A DISPOSITIVO RED",
    "05. Traslado efectivo a lugar de origen": "DERIVACIÓN A DISPOSITIVO RED",
    "06. Acepta CIS pero no hay vacante": "SE RETIRA VOLUNTARIAMENTE",
    "07. Se realiza entrevista y se retira del lugar": "SE RETIRA VOLUNTARIAMENTE",
    "08. No se realiza entrevista y se retira del lugar": "SE RETIRA VOLUNTARIAMENTE",
    "09. Derivación al equipo de Umbral Cero de Primer Abordaje": "DERIVACION UMBRAL CERO",
    "12. Derivación a SAME por deterioro físico visible": "DERIVACION A SAME",
    "13. Derivación a SAME por salud mental": "DERIVACION A SAME",
    "14. Derivación a Seguridad": "DERIVACIÓN A SEGURIDAD Y A ORDENAMIENTO URBANO",
    "15. Derivación a Ordenamiento Urbano": "DERIVACIÓN A SEGURIDAD Y A ORDENAMIENTO URBANO",
    "16. No se observan personas y hay pertenencias": "NO SE CONTACTA",
    "17. No se observan personas ni pertenencias": "NO SE CONTACTA",
    "18. Mendicidad": "NO ERAN PSC",
    "19. Sin cubrir": "SIN CUBRIR",
    "20. Desestimado": "DESESTIMADO",
}
BUCKET_DEFAULT = "Cierres no identificables"

INTERVIEW_CATEGORIES = [
    "01. Traslado efectivo a CIS",
    "02. Traslado efectivo a DIPA",
    "03. Traslado efectivo a Micro",
    "05. Traslado efectivo a lugar de origen",
    "06. Acepta CIS pero no hay vacante",
    "07. Se realiza entrevista y se retira del lugar",
    "09. Derivación al equipo de Umbral Cero de Primer Abordaje",
]

CONTACT_GIVES_DATA = [
    "01. Traslado efectivo a CIS",
    "02. Traslado efectivo a DIPA",
    "03. Traslado efectivo a Micro",
    "05. Traslado efectivo a lugar de origen",
    "06. Acepta CIS pero no hay vacante",
    "09. Derivación al equipo de Umbral Cero de Primer Abordaje",
    "12. Derivación a SAME por deterioro físico visible",
    "13. Derivación a SAME por salud mental",
    "14. Derivación a Seguridad",
    "15. Derivación a Ordenamiento Urbano",
    "18. Mendicidad",
]
CONTACT_NO_DATA = [
    "07. Se realiza entrevista y se retira del lugar",
    "08. No se realiza entrevista y se retira del lugar",
]
NO_CONTACT = [
    "16. No se observan personas y hay pertenencias",
    "17. No se observan personas ni pertenencias",
]

# Tier 0: cleaned text -> category (legacy and current schema, plus specials)
TIER0_EXACT = {
    "01 traslado efectivo a cis": "01. Traslado efectivo a CIS",
    "02 acepta cis pero no hay vacante": "06. Acepta CIS pero no hay vacante",
    "03 se activa protocolo de salud mental": "13. Derivación a SAME por salud mental",
    "05 derivacion a same": "12. Derivación a SAME por deterioro físico visible",
    "07 rechaza entrevista y se retira del lugar": "07. Se realiza entrevista y se retira del lugar",
    "10 derivacion a espacio publico": "15. Derivación a Ordenamiento Urbano",
    "11 no se contacta y se observan pertenencias": "16. No se observan personas y hay pertenencias",
    "12 no se contacta y no se observan pertenencias": "17. No se observan personas ni pertenencias",
    "13 mendicidad menores de edad": "18. Mendicidad",
    "15 sin cubrir": "19. Sin cubrir",
    "16 desestimado cartas 911 u otras areas": "20. Desestimado",
    "01 traslado efectivo a cis 2": "01. Traslado efectivo a CIS",
    "02 traslado efectivo a dipa": "02. Traslado efectivo a DIPA",
    "03 traslado efectivo a micro": "03. Traslado efectivo a Micro",
    "05 traslado efectivo a lugar de origen": "05. Traslado efectivo a lugar de origen",
    "06 acepta cis pero no hay vacante": "06. Acepta CIS pero no hay vacante",
    "07 se realiza entrevista y se retira del lugar": "07. Se realiza entrevista y se retira del lugar",
    "08 no se realiza entrevista y se retira del lugar": "08. No se realiza entrevista y se retira del lugar",
    "09 derivacion al equipo de umbral cero de primer abordaje": "09. Derivación al equipo de Umbral Cero de Primer Abordaje",
    "12 derivacion a same por deterioro fisico visible": "12. Derivación a SAME por deterioro físico visible",
    "13 derivacion a same por salud mental": "13. Derivación a SAME por salud mental",
    "14 derivacion a seguridad": "14. Derivación a Seguridad",
    "15 derivacion a ordenamiento urbano": "15. Derivación a Ordenamiento Urbano",
    "16 no se observan personas y hay pertenencias": "16. No se observan personas y hay pertenencias",
    "17 no se observan personas ni pertenencias": "17. No se observan personas ni pertenencias",
    "18 mendicidad": "18. Mendicidad",
    "19 sin cubrir": "19. Sin cubrir",
    "20 desestimado": "20. Desestimado",
    "derivacion a red": "error de soflex",
    "derivacion area cnnya 102": "14. Derivación a Seguridad",
    "11 derivacion area cnnya 102": "14. Derivación a Seguridad",
    "positivo": "sin_match",
    "06 se realiza entrevista": "08. No se realiza entrevista y se retira del lugar",
    "09 rechaza entrevista y se queda en el lugar": "09. Derivación al equipo de Umbral Cero de Primer Abordaje",
    "04 traslado acompanamiento a otros efectores": "05. Traslado efectivo a lugar de origen",
    "04 traslado efectivo 690": "01. Traslado efectivo a CIS",
    "08 imposibilidad de abordaje por consumo": "08. No se realiza entrevista y se retira del lugar",
    "14 no se encuentra en situacion de calle": "17. No se observan personas ni pertenencias",
    "negativo": "20. Desestimado",
    "derivacion a ep": "15. Derivación a Ordenamiento Urbano",
}

# Tier 1: exact compound codes
TIER1_EXACT = {
    "17 dipa derivacion a cis": "01. Traslado efectivo a CIS",
    "01 positivo traslado a cis hogar 08 positivo derivacion a sas cud cp identidad etc": "01. Traslado efectivo a CIS",
    "10 se contacta pero rechaza pp por desconocimiento voluntad etc": "08. No se realiza entrevista y se retira del lugar",
    "21 asesoramiento sobre programas": "07. Se realiza entrevista y se retira del lugar",
    "16 dipa entrega de insumos servicios 21 asesoramiento sobre programas": "sin_match",
    "16 dipa entrega de insumos servicios 7 positivo entrega de insumos": "sin_match",
    "21 asesoramiento sobre programas 16 dipa entrega de insumos servicios": "sin_match",
    "7 positivo entrega de insumos 16 dipa entrega de insumos servicios": "sin_match",
    "7 positivo entrega de insumos 21 asesoramiento sobre programas": "sin_match",
    "21 asesoramiento sobre programas 7 positivo entrega de insumos": "sin_match",
    "16 dipa entrega de insumos servicios 21 asesoramiento sobre programas 7 positivo entrega de insumos": "sin_match",
    "11 se contacta pero rechaza pp por disconformidad egresado": "08. No se realiza entrevista y se retira del lugar",
    "10 se contacta pero rechaza pp por desconocimiento voluntad etc 11 se contacta pero rechaza pp por disconformidad egresado": "08. No se realiza entrevista y se retira del lugar",
    "9 se contacta pero rechaza entrevista 21 asesoramiento sobre programas": "08. No se realiza entrevista y se retira del lugar",
    "9 se contacta pero rechaza entrevista 24 persona abandona el lugar por intervencion ep policia": "08. No se realiza entrevista y se retira del lugar",
    "21 asesoramiento sobre programas 10 se contacta pero rechaza pp por desconocimiento voluntad etc": "08. No se realiza entrevista y se retira del lugar",
    "10 se contacta pero rechaza pp por desconocimiento voluntad etc 21 asesoramiento sobre programas": "08. No se realiza entrevista y se retira del lugar",
    "21 asesoramiento sobre programas 9 se contacta pero rechaza entrevista": "08. No se realiza entrevista y se retira del lugar",
    "10 se contacta pero rechaza pp por desconocimiento voluntad etc 9 se contacta pero rechaza entrevista": "08. No se realiza entrevista y se retira del lugar",
    "asesoramiento sobre programas rechan entrevista se quedan en el lugar": "09. Derivación al equipo de Umbral Cero de Primer Abordaje",
}

# Tier 2: ordered substring rules, first hit wins (order is significant)
TIER2_SUBSTRING = [
    ("deterioro fisico", "12. Derivación a SAME por deterioro físico visible"),
    ("salud mental", "13. Derivación a SAME por salud mental"),
    ("umbral cero", "09. Derivación al equipo de Umbral Cero de Primer Abordaje"),
    ("ordenamiento urbano", "15. Derivación a Ordenamiento Urbano"),
    ("lugar de origen", "05. Traslado efectivo a lugar de origen"),
    ("traslado a micro", "03. Traslado efectivo a Micro"),
    ("traslado efectivo a micro", "03. Traslado efectivo a Micro"),
    ("traslado a dipa", "02. Traslado efectivo a DIPA"),
    ("traslado efectivo a dipa", "02. Traslado efectivo a DIPA"),
    ("dipa combate", "02. Traslado efectivo a DIPA"),
    ("derivacion a cis", "01. Traslado efectivo a CIS"),
    ("traslado a cis", "01. Traslado efectivo a CIS"),
    ("traslado efectivo a cis", "01. Traslado efectivo a CIS"),
    ("ingreso micro", "03. Traslado efectivo a Micro"),
    ("traslados micro", "03. Traslado efectivo a Micro"),
    ("micro solidario", "03. Traslado efectivo a Micro"),
    ("se lo traslada a micro", "03. Traslado efectivo a Micro"),
    ("se los traslada a micro", "03. Traslado efectivo a Micro"),
    ("acepta cis", "06. Acepta CIS pero no hay vacante"),
    ("protocolo de salud mental", "13. Derivación a SAME por salud mental"),
    (" same", "12. Derivación a SAME por deterioro físico visible"),
    ("no se contacta y no se", "17. No se observan personas ni pertenencias"),
    ("informa no se contacta", "17. No se observan personas ni pertenencias"),
    ("no se contacta y se ob", "16. No se observan personas y hay pertenencias"),
    ("se retira del lugar", "07. Se realiza entrevista y se retira del lugar"),
    ("se retiran del lugar", "07. Se realiza entrevista y se retira del lugar"),
    ("se retira", "07. Se realiza entrevista y se retira del lugar"),
    ("eximicion", "07. Se realiza entrevista y se retira del lugar"),
    ("asesoramiento", "07. Se realiza entrevista y se retira del lugar"),
    ("se realiza entrevista y se retira", "07. Se realiza entrevista y se retira del lugar"),
    ("no se realiza entrevista", "08. No se realiza entrevista y se retira del lugar"),
    ("rechaza entrevista y se retira", "08. No se realiza entrevista y se retira del lugar"),
    ("rechaza y se queda", "09. Derivación al equipo de Umbral Cero de Primer Abordaje"),
    ("rechaza entrevista y se queda", "09. Derivación al equipo de Umbral Cero de Primer Abordaje"),
    ("se queda en el lugar", "09. Derivación al equipo de Umbral Cero de Primer Abordaje"),
    ("queda en el lugar", "09. Derivación al equipo de Umbral Cero de Primer Abordaje"),
    ("permanece en el lugar", "09. Derivación al equipo de Umbral Cero de Primer Abordaje"),
    ("rechaza entrevista", "08. No se realiza entrevista y se retira del lugar"),
    ("imposibilidad de abordaje", "08. No se realiza entrevista y se retira del lugar"),
    ("rechaz", "08. No se realiza entrevista y se retira del lugar"),
    ("espacio publico", "15. Derivación a Ordenamiento Urbano"),
    ("mendicidad", "18. Mendicidad"),
    ("sin cubrir", "19. Sin cubrir"),
    ("desestimado", "20. Desestimado"),
    ("derivacion a red", "error de soflex"),
    ("derivacion area cnnya", "14. Derivación a Seguridad"),
    ("cnnya", "14. Derivación a Seguridad"),
    ("cnnva", "14. Derivación a Seguridad"),
    ("nnnya", "14. Derivación a Seguridad"),
    ("nnya 102", "14. Derivación a Seguridad"),
    ("seguridad", "14. Derivación a Seguridad"),
]

FUZZY_ACCEPT_SCORE = 80.0
NO_MATCH = "sin_match"

# Origin -> report group (weekly origin report)
ORIGIN_GROUP = {
    "SIN TECHO": "Vecino / ONG / PST",
    "ESPONTANEO": "Vecino / ONG / PST",
    "VECINO": "Vecino / ONG / PST",
    "ONG": "Vecino / ONG / PST",
    "GESTION COLABORATIVA": "Vecino / ONG / PST",
    "911": "Gobierno Ciudad (Coop.)",
    "ORGANISMOS PUBLICOS": "Gobierno Ciudad (Coop.)",
    "DESDE BAP/MDR": "Gobierno Ciudad (Coop.)",
    "PUNTO POLITICO/INGRESO POR FUERA 108": "Gobierno Ciudad (Coop.)",
    "SUBTE": "Gobierno Ciudad (Coop.)",
    "ESPACIOS PUBLICOS": "Gobierno Ciudad (Coop.)",
    "JUDICIALES": "Gobierno Ciudad (Coop.)",
    "BOTI": "Gobierno Ciudad (Coop.)",
    "MONITOREO 108": "Gobierno Ciudad (Coop.)",
    "CAJEROS": "Gobierno Ciudad (Coop.)",
    "SEGUIMIENTO": "Gobierno Ciudad (Coop.)",
    "ADICCIONES": "Gobierno Ciudad (Coop.)",
    "NIÑA/NIÑO": "Gobierno Ciudad (Coop.)",
}
ORIGIN_EXCLUDED = ["EQUIVOCADO", "CORTAN"]
ORIGIN_EXCLUDED_MARK = "__excluir__"
ORIGIN_NULL_GROUP = "Sin origen"

MANUAL_GROUP = {
    "MONITOREO 108": "Llamados 108",
    "BOTI": "Llamados 108",
    "VECINO": "Llamados 108",
    "CAJEROS": "Llamados 108",
    "SIN TECHO": "Llamados 108",
    "ONG": "Llamados 108",
    "GESTION COLABORATIVA": "BA Colaborativa / 911",
    "911": "BA Colaborativa / 911",
    "SUBTE": "BA Colaborativa / 911",
    "JUDICIALES": "BA Colaborativa / 911",
    "ESPACIOS PUBLICOS": "BA Colaborativa / 911",
    "ORGANISMOS PUBLICOS": "BA Colaborativa / 911",
    "DESDE BAP/MDR": "BA Colaborativa / 911",
    "PUNTO POLITICO/INGRESO POR FUERA 108": "Casos particulares",
    "SEGUIMIENTO": "Casos particulares",
    "NIÑA/NIÑO": "Casos particulares",
    "ADICCIONES": "Casos particulares",
    "ESPONTANEO": "Espontáneas",
}
MANUAL_GROUP_DEFAULT = "Otros"
MANUAL_GROUP_ORDER = ["Llamados 108", "BA Colaborativa / 911", "Casos particulares", "Espontáneas"]
LEVEL_ORDER = ["Se contacta", "No se contacta", "Sin cubrir", "Desestimado", "Seguimiento"]

PRIORITY_DISTRICTS = [2.0, 13.0, 14.0, 1.5]
HIGHLIGHT_DISTRICT_KEYS = ["1.5", "2", "12", "13", "14"]

EXCLUDED_AGENCIES = [
    "DIPA I COMBATE", "MAPA DE RIESGO - SEGUIMIENTO",
    "MAPA DE REISGO - SEGUIMIENTO", "DIPA II ZABALA",
    "AREA OPERATIVA", "SALUD MENTAL",
]
PLACEHOLDER_VALUES = ["", " ", "-", "N/A", "(Vacio)", "SIN DATO", "nan", "NAN"]

INVALID_ID_TEXTS = [
    "NO BRINDO/NO VISIBLE", "NO BRINDO", "NO VISIBLE", "S/D", "X",
    "NAN", "nan", "NaN", "", " ", "NONE", "None",
    "0", "1", "2", "3", "4", "5", "6", "7", "8", "9",
    "123", "1234", "12345", "11111111", "00000000", "111111", "222222", "333333", "-", "/",
]
ANONYMOUS_ID_LABELS = ["NO BRINDO/NO VISIBLE", "NO BRINDO", "NO VISIBLE", "S/D"]
NO_ID = "NO BRINDO/NO VISIBLE"
FOREIGN_ID = "CONTACTO EXTRANJERO"

# Raw outcome remap of the one-time migration (None = nullify from the cutoff on)
RAW_OUTCOME_REMAP = {
    "01-Traslado efectivo a CIS": "01. Traslado efectivo a CIS",
    "02-Acepta CIS pero no hay vacante": "06. Acepta CIS pero no hay vacante",
    "03-Se activa Protocolo de Salud Mental": "13. Derivación a SAME por salud mental",
    "05-Derivación a SAME": "12. Derivación a SAME por deterioro físico visible",
    "07-Rechaza entrevista y se retira del lugar": "07. Se realiza entrevista y se retira del lugar",
    "10-Derivación a Espacio Público": "15. Derivación a Ordenamiento Urbano",
    "11-No se contacta y se observan pertenencias": "16. No se observan personas y hay pertenencias",
    "12–No se contacta y no se observan pertenencias": "17. No se observan personas ni pertenencias",
    "13-Mendicidad (menores de edad)": "18. Mendicidad",
    "15-Sin cubrir": "19. Sin cubrir",
    "16-Desestimado (cartas 911 u otras áreas)": "20. Desestimado",
    "04-Traslado/acompañamiento a otros efectores": None,
    "06-Se realiza entrevista": None,
    "08-Imposibilidad de abordaje por consumo": None,
    "09-Rechaza entrevista y se queda en el lugar": None,
    "14-No se encuentra en situación de calle": None,
    "NEGATIVO": None,
}
REMAP_NULLIFY_FROM = "2026-01-01"

# Report-side fixed labels
INTERVIEW_CLASSES = ["Brinda DNI", "No brinda", "No realiza entrevista"]
OUTCOME_CLASSES = [
    "DERIVACIÓN A DISPOSITIVO RED",
    "DERIVACION A SAME",
    "SE RETIRA VOLUNTARIAMENTE",
    "DERIVACIÓN A SEGURIDAD Y A ORDENAMIENTO URBANO",
    "DERIVACION UMBRAL CERO",
    "NO ERAN PSC",
]
LEGACY_DASHBOARD_BUCKETS = ["SE DERIVA", "CASOS DE SALUD MENTAL", "SE RETIRA", "ESPACIO PUBLICO",
                            "ACEPTA CIS SIN VACANTE", "MENDICIDAD", "Cierres no identificables"]
EVOLUTION_LABELS = ["Nuevos", "Recurrentes", "Migratorios", "Nuevo repetido", "No clasificable"]
KPI_ROWS = ["Intervenciones totales", "Derivaciones CIS", "Llamados 108",
            "% Se contacta", "% No se contacta", "% Sin cubrir"]
REPORT_WEEKS = 8
# Chart series colours (evolution charts), in series order
EVOLUTION_SERIES = [("Nuevos", "#10B981"), ("Recurrentes", "#3B82F6"), ("Migratorios", "#F97316")]
# Dashboard KPI baseline column, per zone, in KPI row order ("-" elsewhere)
KPI_BASELINES = {
    "c2": ["341", "26", "175", "38% (66)", "53% (92)", "9% (16)"],
    "total": ["4344", "341", "2798", "27% (782)", "25% (717)", "46% (1299)"],
}
KPI_BASELINE_DEFAULT = "-"

# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------
