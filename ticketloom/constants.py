"""Fixed values of the ticket domain: headers, word lists, spelling maps, defaults.

Results depend on these exact values, so they are stated plainly.
"""

# --- Fixed values: canonical headers ---------------------------------------
INCIDENT_NUMBER = "N° d'Incident"
RAW_OMV = "INTERVENTION OMV"
RAW_SERVICE = "SERVICE"
RAW_ORIGINE = "ORIGINE"
RAW_DESCRIPTION = "Description"
RAW_TRAITE = "Traité par"
RAW_CAUSE = "Cause réelle"
RAW_URGENCE = "Urgence"
RAW_DEMANDEUR = "Demandeur"

RAW_COLUMNS = [
    INCIDENT_NUMBER, RAW_OMV, RAW_SERVICE, RAW_ORIGINE, RAW_DESCRIPTION, RAW_TRAITE, RAW_CAUSE,
]
SOURCE_COLUMN = "_source"

# --- Fixed values: accepted spellings of a header, after normalisation ------
HEADER_ALIASES = {
    "n dincident": INCIDENT_NUMBER,
    "nincident": INCIDENT_NUMBER,
    "numero incident": INCIDENT_NUMBER,
    "n incident": INCIDENT_NUMBER,
    "intervention omv": RAW_OMV,
    "intervention": RAW_OMV,
    "omv": RAW_OMV,
    "service": RAW_SERVICE,
    "origine": RAW_ORIGINE,
    "description": RAW_DESCRIPTION,
    "traite par": RAW_TRAITE,
    "cause reelle": RAW_CAUSE,
}

# --- Fixed values: cells that a default pandas CSV read takes as missing -----
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- Fixed values: labels and defaults -------------------------------------
YES, NO = "OUI", "NON"
UNKNOWN = "INCONNU"
NO_CITY = "NON_PRECISEE"
ALL_SERVICES = "TOUS"
SOURCE_LOOKUP, SOURCE_DEFAULT = "deterministe", "tous"
ROW_ERROR = "ERREUR"
CARRIAGE_MARK = "_x000D_"

# --- Fixed values: spelling repairs ----------------------------------------
ORIGINE_SPELLING = {
    "BASE DE DONNEES": "BASE DE DONNÉES",
    "ASSISTANCE UTILISATEUR": "ASSISTANCE UTILISATEURS",
    "PARAMETRAGE": "PARAMÉTRAGE",
    "ERREUR SAISIE": "ERREUR DE SAISIE",
    "TELEPHONE": "TÉLÉPHONE",
    "DONNEES": "DONNÉES",
    "FISCALITE": "FISCALITÉ",
}
SERVICE_SPELLING = {"DÉCÈS": "DECES"}
CELL_REPAIRS = {"SER I": "SER IND PARIS", "SERI": "SER IND PARIS", "SERC": "SER COLL PARIS"}

# --- Fixed values: cities looked for in a description ------------------------
CITIES = [
    "PARIS", "NANCY", "LYON", "BORDEAUX", "MARSEILLE",
    "TOULOUSE", "NANTES", "STRASBOURG", "LILLE", "RENNES",
]

# --- Fixed values: French stop words -----------------------------------------
STOP_WORDS = [
    "a", "au", "aux", "avec", "car", "ce", "ceci", "cela", "ces", "cet", "cette", "dans", "de",
    "des", "donc", "du", "elle", "elles", "en", "entre", "et", "eux", "ici", "il", "ils", "je",
    "la", "là", "le", "les", "leur", "leurs", "lui", "lors", "ma", "mais", "me", "même", "mes",
    "mon", "ni", "nos", "notre", "nous", "on", "or", "ou", "où", "par", "pas", "plus", "pour",
    "puis", "qu", "que", "quand", "quel", "quelle", "quels", "quelles", "qui", "sa", "sans",
    "sauf", "se", "ses", "si", "son", "sur", "ta", "te", "tes", "ton", "tout", "tous", "toute",
    "toutes", "très", "trop", "tu", "un", "une", "via", "voir", "vos", "votre", "vous", "y",
    "à", "été", "être", "est", "sont",
]

# --- Fixed values: model settings --------------------------------------------
SEED = 42
TEST_SIZE = 0.2
MIN_SAMPLES = 30
FOLDS = 5
SVC_C = {"omv": 0.5, "origine": 5.0}
CATEGORY_COLUMNS = ["cause", "traite", "demandeur", "ville", "urgence_cat"]
TARGET_COLUMNS = {"omv": "omv", "service": "service_clean", "origine": "origine_clean"}

# --- Fixed values: tuning grids ------------------------------------------------
TUNING_GRIDS = {
    "logreg": {
        "omv": {"C": [0.5, 1.0, 2.0, 5.0], "solver": ["liblinear", "saga"]},
        "origine": {"C": [1.0, 2.0, 5.0, 10.0], "solver": ["saga"]},
    },
    "linearsvc": {"omv": {"C": [0.1, 0.5, 1.0, 5.0]}, "origine": {"C": [0.1, 0.5, 1.0, 5.0]}},
    "random_forest": {
        "omv": {"num_trees": [100, 200], "max_depth": [None, 10], "min_leaf": [1, 3]},
        "origine": {"num_trees": [100, 200], "max_depth": [None, 10, 20], "min_leaf": [1, 3]},
    },
}
NGRAM_GRID = {
    "ngram_range": [(1, 1), (1, 2), (1, 3), (2, 2), (2, 3)],
    "max_features": [8000, 12000, 20000],
    "C": [0.1, 0.5, 1.0, 5.0],
}

# --- Fixed values: reference quality a run is compared with --------------------
BASELINE_METRICS = {
    "OMV": {"accuracy": 0.985, "f1_macro": 0.990},
    "SERVICE": {"accuracy": 0.758, "f1_macro": 0.665},
    "ORIGINE": {"accuracy": 0.735, "f1_macro": 0.752},
}

# --- Fixed values: columns of the run log ---------------------------------------
RUN_LOG_COLUMNS = [
    "timestamp", "run_id", "pipeline", "model_type",
    "omv_acc", "omv_f1", "svc_acc", "svc_f1", "ori_acc", "ori_f1", "comment",
]
