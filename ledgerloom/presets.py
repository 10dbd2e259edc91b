"""Fixed values of the public-accounts domain.

Everything here is data that results depend on: code lists, label maps,
patterns and column positions. Operators take them as parameters, so another
authority's layout is a different set of values, not different code.
"""

from __future__ import annotations

# --- fixed values: value labels printed in the summary and leaf reports ------
VALUE_LABELS = [
    "ECP", "FPV", "RS", "RR", "PR", "EP", "EC", "RC", "CP", "CS", "TP", "TR", "PC", "I", "A", "R",
]

# --- fixed values: (label, occurrence in the block) -> measure ----------------
SPENDING_LEAF_MEASURES = {
    ("CP", 0): "previsioni",
    ("I", 0): "impegni",
    ("TP", 0): "pagamenti_totali",
    ("PC", 0): "pagamenti_c_competenza",
    ("PR", 0): "pagamenti_c_residui",
    ("RS", 0): "residui_iniziali",
    ("R", 0): "riaccertamento_residui",
    ("EP", 0): "residui_da_eserc_prec",
    ("ECP", 0): "economie_competenza",
    ("EC", 0): "residui_da_competenza",
    ("CS", 0): "previsioni_cassa",
    ("FPV", 0): "fpv",
    ("TR", 0): "residui_da_riportare",
}
REVENUE_LEAF_MEASURES = {
    ("CP", 0): "previsioni",
    ("A", 0): "accertamenti",
    ("TR", 0): "riscossioni_totali",
    ("RC", 0): "riscossioni_c_competenza",
    ("RR", 0): "riscossioni_c_residui",
    ("RS", 0): "residui_iniziali",
    ("R", 0): "riaccertamento_residui",
    ("EP", 0): "residui_da_eserc_prec",
    ("CP", 1): "maggiori_minori_accertamenti",
    ("EC", 0): "residui_da_competenza",
    ("CS", 0): "previsioni_cassa",
    ("CS", 1): "maggiori_minori_cassa",
    ("TR", 1): "residui_da_riportare",
}

# --- fixed values: summary reports (first occurrence of the label counts) -----
SPENDING_SUMMARY = {
    "kind": "spesa",
    "markers": r"^(Missione\s+\d+|TOTALE MISSIONI|TOTALE GENERALE DELLE SPESE|DISAVANZO)",
    "header": r"^Missione\s+(\d+)\s+(.+?)\s+RS\s",
    "code_width": 2,
    "total_prefix": "TOTALE GENERALE DELLE SPESE",
    "total_name": "Totale generale delle spese",
    "measures": {"CP": "previsioni", "I": "impegni", "TP": "pagamenti_totali"},
}
REVENUE_SUMMARY = {
    "kind": "entrata",
    "markers": r"^(TITOLO\s+\d+:|TOTALE DEI TITOLI|TOTALE GENERALE DELLE ENTRATE|FONDO|UTILIZZO)",
    "header": r"^TITOLO\s+(\d+):\s+(.+?)\s+RS\s",
    "code_width": 0,
    "total_prefix": "TOTALE GENERALE DELLE ENTRATE",
    "total_name": "Totale generale delle entrate",
    "measures": {"CP": "previsioni", "A": "accertamenti", "TR": "riscossioni_totali"},
}

# --- fixed values: headings of the leaf report and the level each one sets ----
LEAF_HEADING = r"^(TITOLO|MISSIONE|PROGRAMMA|MACROAGGREGATO|TIPOLOGIA|CATEGORIA)\s+(\d+)\s*:\s*(.*)$"
LEAF_LEVELS = {
    "spesa": {"MISSIONE": 1, "PROGRAMMA": 2, "MACROAGGREGATO": 3},
    "entrata": {"TITOLO": 1, "TIPOLOGIA": 2, "CATEGORIA": 3},
}
LEAF_SECTION_HEADING = {"spesa": "TITOLO", "entrata": None}
LEAF_CODE_PADDING = {("spesa", 1): 2}
LEAF_SIDE_MARKS = {"spesa": "- SPESE (anno", "entrata": "- ENTRATE (anno"}
LEAF_LINE = r"^\s*(?:\d{1,3}\s+){2,4}(\d{9,12})\s*(.*)$"
LEAF_CODE_LENGTH = 12
# Repeated page headers and footers; some are column titles read backwards.
LEAF_BOILERPLATE = r"COMUNE DI TORINO|Data di stampa|\.?RGGAORCAM|OLOTIT|ENOISSIM|AMMARGORP|AIGOLOPIT|AIROGETAC|CODICE$|CODICE PREVISIONI|CAPITOLO$|DENOMINAZIONE\b|PREVISIONI DEFINITIVE DI|CASSA \(CS\)|RESIDUI (ATTIVI|PASSIVI) (AL|DA)|\(RS\) PREC\.|RIPORT\. \(TR|TOTALE RESIDUI (ATTIVI|PASSIVI) DA"

# --- fixed values: which measures are reconciled on each side -----------------
RECONCILED_MEASURES = {
    "entrata": ["accertamenti", "riscossioni_totali"],
    "spesa": ["impegni", "pagamenti_totali"],
}

# --- fixed values: statement line codes, totals, memo phrases -----------------
STATEMENT_CODE = (
    r"^(?:[A-E]\)|[A-E]\.[IVX]+\.|[A-E]\.(?![IVX])|\d{1,2}(?:-(?:bis|ter|quater))?\)"
    r"|\d{1,2}\s+bis\)|\d{1,2}(?=\s+[A-Z][a-z]{2})|[a-z](?:-bis)?[.\)])"
)
STATEMENT_TOTAL_PREFIXES = ["TOTALE", "RISULTATO", "DIFFERENZATRA", "UTILE(PERDITA)DELL"]
STATEMENT_MEMO = (
    r"(?i)\b(valore al lordo|meno\s*:?\s*fondo|meno fondo|di cui|entro 12|oltre 12)\b"
)
RELATED_PARTY_RULES = [
    ("gruppo_socio", ["controllo delle controllanti", "controllo di controllanti"]),
    ("socio", ["controllanti", "controllante"]),
    ("controllate", ["controllate", "collegate"]),
]
FORM_OWNER_RULES = [("socio", ["comune di torino"])]
ENTITY_TYPE_RULES = [
    ("fondazione", ["FONDAZIONE"]),
    ("associazione", ["ASSOCIAZIONE"]),
    ("consorzio", ["CONSORZIO"]),
    ("comitato", ["COMITATO"]),
    ("istituzione", ["ISTITUZIONE"]),
    ("agenzia", ["AGENZIA", "AGENZIE"]),
    ("società", ["S.P.A", "S.R.L", "S.C.AR.L", " SPA", " SRL"]),
]
OTHER_ENTITY_TYPE = "altro"

# --- fixed values: statement page layouts (points from the left edge) ---------
CIVIL_LAYOUT = {"prior_x1_min": 548.0, "current_x1_min": 250.0, "row_tolerance": 3.5}
FOUR_COLUMN_LAYOUT = {
    "current_x1_max": 370.0,
    "prior_x1_min": 430.0,
    "prior_x1_max": 495.0,
    "label_x0_max": 255.0,
    "skip_top": 70.0,
    "label_gap": 10.0,
    "row_tolerance": 3.5,
}
FOUR_COLUMN_NOTE = r"^\(\d{1,2}\)$"
FOUR_COLUMN_TOTAL_WORDS = ["totale", "risultato", "margine", "ebit", "ebitda"]
COUNTERPARTY_BOUNDS = [336.0, 393.0, 450.0, 506.0]
COUNTERPARTY_BOUNDS_CONSOLIDATED = [310.0, 375.0, 440.0, 505.0]
COUNTERPARTY_LABEL_X0_CONSOLIDATED = 230.0
ASSETS, LIABILITIES, INCOME = (
    "stato_patrimoniale_attivo", "stato_patrimoniale_passivo", "conto_economico",
)
COUNTERPARTY_LEFT = [
    ("Crediti Commerciali", ASSETS),
    ("Crediti Finanziari e Disponibilità liquide", ASSETS),
    ("Crediti di altra natura", ASSETS),
    ("Debiti Commerciali", LIABILITIES),
    ("Debiti Finanziari", LIABILITIES),
]
COUNTERPARTY_RIGHT = [
    ("Debiti di altra natura", LIABILITIES),
    ("Ricavi e altri proventi", INCOME),
    ("Costi e altri oneri", INCOME),
    ("Proventi finanziari", INCOME),
    ("Oneri finanziari", INCOME),
]

# --- fixed values: decision documents -----------------------------------------
DECISION_ID = r"C\.?\s?I\.?\s?G\.?\s*[:.]?\s*([0-9A-Z]{10})\b"
DECISION_AMOUNTS = [
    r"(?i)IMPEGNO DI SPESA[^\d]{0,20}([\d.]+,\d{2})",
    r"(?i)PRESUNTA[^\d]{0,12}EURO\s*([\d.]+,\d{2})",
    r"(?i)base di gara[^\d]{0,40}([\d.]+,\d{2})",
    r"(?i)EURO\s*([\d.]+,\d{2})",
]
DECISION_CHAPTER = r"(?i)Descrizione\s+[Cc]apitolo\s*(?:e\s*(?:articolo)?)?"
DECISION_STOP = r"(?i)Conto\s+Finanziario|[Ii]mporto\s+[Aa]nno|^\s*$"
DECISION_MONEY = r"\d{1,3}(?:\.\d{3})*,\d{2}"
DECISION_YEAR = r"\b(20\d{2})\b"
DECISION_CODE = r"\b(\d{9,12})\b"

# --- fixed values: display labels of the debt series --------------------------
MEASURE_LABELS = {
    "residuo_iniziale": "Residuo debito a inizio anno",
    "nuovi_prestiti": "Nuovi prestiti accesi nell'anno",
    "prestiti_rimborsati": "Prestiti rimborsati (quota capitale)",
    "debito_fine_anno": "Debito residuo a fine anno",
    "oneri_finanziari": "Oneri finanziari (interessi passivi)",
    "abitanti": "Abitanti al 31/12",
    "debito_pro_capite": "Debito medio per abitante",
}

# --- fixed values: programme codes in the column order of the spending matrix --
PROGRAMME_COLUMNS = [
    "01", "02", "03", "04", "05", "06", "07", "08", "09", "10", "11", "12",
    "13", "14", "15", "16", "17", "18", "19", "20", "50", "60", "99",
]

# --- fixed values: statement families of the two balance sheets of a report ----
CONSOLIDATED_SHEET = ["balance_sheet_assets", "balance_sheet_liabilities"]
AGGREGATE_SHEET = ["aggregate_balance_sheet_assets", "aggregate_balance_sheet_liabilities"]

# --- fixed values: display labels of entity metrics and of summary measures ----
ENTITY_METRIC_LABELS = {
    "spesa_personale": "Spesa per il personale",
    "perc_consolidamento": "Percentuale di consolidamento",
    "incidenza_ricavi_comune": "Incidenza ricavi imputabili al Comune",
    "perdite_ripianate_comune": "Perdite ripianate dal Comune (ultimi 3 anni)",
    "quota_posseduta": "Quota posseduta",
    "valore_iscrizione_partecipazione": "Valore di iscrizione della partecipazione",
    "patrimonio_netto": "Patrimonio netto dell'organismo",
    "frazione_patrimonio_netto": "Frazione del patrimonio netto",
    "differenza_elisione": "Differenza di elisione",
}
SUMMARY_MEASURE_LABELS = {
    "impegni": "Impegni (competenza)",
    "pagamenti_totali": "Pagamenti (cassa)",
    "accertamenti": "Accertamenti (competenza)",
    "riscossioni_totali": "Riscossioni (cassa)",
    "previsioni": "Previsioni definitive",
}
