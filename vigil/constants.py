"""Fixed values that must equal the reference's for equal results.

Everything here is a plain value, kept together and in natural order.
Operators take these as parameter defaults; callers may override them.
"""

# --- fixed values: risk levels, in report order (O3) -------------------
LEVEL_LOW = "BAJO_RIESGO"
LEVEL_MODERATE = "RIESGO_MODERADO"
LEVEL_HIGH = "ALTO_RIESGO"
LEVELS = [LEVEL_LOW, LEVEL_MODERATE, LEVEL_HIGH]

# --- fixed values: feature vector -------------------------------------
FEATURE_COLUMNS = [
    "reciprocity_ratio_norm",
    "days_since_last_seen_norm",
    "ratio_night_messages",
    "is_profile_incomplete",
    "sentiment_negativity_index",
    "num_community_categories_norm",
]
# Columns MinMax-scaled by the batch transform, before their renames.
SCALED_RAW_COLUMNS = [
    "reciprocity_ratio",
    "days_since_last_seen",
    "ratio_night_messages",
    "sentiment_negativity_index",
    "num_community_categories",
]
RENAMES = {
    "reciprocity_ratio": "reciprocity_ratio_norm",
    "days_since_last_seen": "days_since_last_seen_norm",
    "num_community_categories": "num_community_categories_norm",
}
FINAL_COLUMNS = [
    "user_id_raiz",
    "reciprocity_ratio_norm",
    "days_since_last_seen_norm",
    "ratio_night_messages",
    "is_profile_incomplete",
    "sentiment_negativity_index",
    "num_community_categories_norm",
    "int_gaming_one_hot",
    "comm_voluntariado_one_hot",
]
VOLUNTEER_CATEGORY = "Voluntariado"

# --- fixed values: KPI rules -------------------------------------------
NIGHT_HOUR_FIRST = 1
NIGHT_HOUR_LAST = 5
DAYS_WHEN_NEVER_SEEN = 365.0
SECONDS_PER_DAY = 86400.0

# --- fixed values: ensemble --------------------------------------------
KMEANS_K = 4
KMEANS_SEED = 42
KMEANS_RESTARTS = 10
DBSCAN_EPS = 0.5
DBSCAN_MIN_SAMPLES = 5
IFOREST_TREES = 100
IFOREST_CONTAMINATION = 0.1
IFOREST_SEED = 42
IFOREST_MAX_SAMPLES = 256
PCA_COMPONENTS = 2
SEVERITY_WEIGHT_IFOREST = 0.5
SEVERITY_WEIGHT_DBSCAN = 0.3
SEVERITY_WEIGHT_KMEANS = 0.2
SEVERITY_EPS = 1e-10
# k-means risk cluster = argmax(center[days] - center[communities]).
RISK_CENTER_PLUS = 1
RISK_CENTER_MINUS = 5

# --- fixed values: heuristic score (stream and reports) ----------------
HEUR_W_DAYS = 0.25
HEUR_W_NIGHT = 0.20
HEUR_W_INCOMPLETE = 0.15
HEUR_W_NEGATIVITY = 0.25
HEUR_W_COMMUNITY = 0.15
HEUR_CUT_HIGH = 0.6
HEUR_CUT_MODERATE = 0.3

# --- fixed values: streaming caps --------------------------------------
CAP_RECIPROCITY = 10.0
CAP_DAYS = 365.0
CAP_COMMUNITIES = 12.0

# --- fixed values: reports ---------------------------------------------
SEVERITY_BINS = [0, 20, 40, 60, 80, 100]
SEVERITY_BIN_LABELS = ["0-20", "20-40", "40-60", "60-80", "80-100"]
SEVERITY_HIGH_MARK = 60
CHART_BINS = 20
CHART_BAND_LOW = 30
CHART_BAND_HIGH = 60
CH_CHART_SCALE = 500.0
TREND_HOURS_DEFAULT = 24
TREND_HOURS_MIN = 1
TREND_HOURS_MAX = 168
TOPK_DEFAULT = 10
TOPK_MIN = 1
TOPK_MAX = 50
N_CLUSTERS_MIN = 2
N_CLUSTERS_MAX = 10
CONTAMINATION_MIN = 0.01
CONTAMINATION_MAX = 0.5
URGENT_SEVERITY = 80

# --- fixed values: messages and channels -------------------------------
MSG_USER_RISK_UPDATE = "USER_RISK_UPDATE"
MSG_DISTRIBUTION_UPDATE = "DISTRIBUTION_UPDATE"
MSG_CRITICAL_ALERT = "CRITICAL_ALERT"
CHANNEL_CLUSTERING = "clustering"
CHANNEL_ALERTS = "alerts"
CHANGE_CHANNEL = "data_change"
HISTORY_MAX = 50
HISTORY_ON_CONNECT = 10
ALERT_ACTION = "Revisar perfil del usuario y considerar contacto"
ALERT_CONTEXT = "Usuario requiere atención prioritaria del equipo de salud mental"
ALERT_FACTOR_TABLE = "Cambio detectado en: "
ALERT_FACTOR_PREVIOUS = "Riesgo anterior: "
ALERT_FACTOR_CURRENT = "Riesgo actual: "
PRIORITY_URGENT = "URGENT"
PRIORITY_HIGH = "HIGH"

# --- fixed values: text scoring ----------------------------------------
TEXT_MIN_STRIPPED = 3
MODEL_BATCH = 32
NEGATIVE_LABELS = ["NEG", "NEGATIVE", "LABEL_0"]
# Lexicon for the built-in scorer: words seen only in toxic labelled rows.
NEGATIVE_LEXICON = [
    "trash", "scum", "clown", "idiot", "worthless",
    "moron", "pathetic", "loser", "disgusting", "stupid",
]
# Python's str.strip() whitespace set, as regex code points.
PY_WHITESPACE = [
    "0009", "000A", "000B", "000C", "000D", "001C", "001D", "001E", "001F",
    "0020", "0085", "00A0", "1680", "2000", "2001", "2002", "2003", "2004",
    "2005", "2006", "2007", "2008", "2009", "200A", "2028", "2029", "202F",
    "205F", "3000",
]

# --- fixed values: change capture --------------------------------------
CDC_OPERATIONS = ["INSERT", "UPDATE", "DELETE"]
LOAD_CHUNK_ROWS = 1000
