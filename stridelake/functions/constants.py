"""Fixed values.

FIXED VALUES — these must equal the business rules the engine reproduces
(rule names, user-facing messages, sport lists, commute rules, default
benefit parameters). They are data, stated plainly and in natural order;
change them only when the business rule changes.
"""

from __future__ import annotations

# --- Sports -----------------------------------------------------------------
# Sports for which a distance in km is expected (and shown in notifications).
DISTANCE_SPORTS = ["Marche", "Running", "Randonnée", "Triathlon"]

# Sports for which a distance is not expected.
NON_DISTANCE_SPORTS = [
    "Judo", "Boxe", "Tennis", "Badminton", "Tennis de table", "Basketball",
    "Football", "Rugby", "Escalade", "Équitation", "Natation", "Voile",
]

# Known misspelling and its correction.
MISSPELLED_SPORT = "Runing"
SPORT_NORMALISATION = {"Runing": "Running"}

# Label used when an employee has no declared sport.
DEFAULT_SPORT = "Marche"

# --- Commute ----------------------------------------------------------------
MODE_WALK = "Marche/running"
MODE_BIKE = "Vélo/Trottinette/Autres"
PHYSICAL_MODES = [MODE_WALK, MODE_BIKE]

# commute mode -> (routing travel mode, threshold in km)
COMMUTE_RULES = [
    (MODE_WALK, "WALK", 15),
    (MODE_BIKE, "BICYCLE", 25),
]

STATUS_VALID = "VALID"
STATUS_ANOMALY = "ANOMALY"
STATUS_NOT_APPLICABLE = "NOT_APPLICABLE"
STATUS_ERROR = "ERROR"
COMMUTE_STATUSES = [STATUS_VALID, STATUS_ANOMALY, STATUS_NOT_APPLICABLE, STATUS_ERROR]

# Anomaly text: "Distance {km} km supérieure au seuil de {threshold} km."
ANOMALY_PREFIX = "Distance "
ANOMALY_MIDDLE = " km supérieure au seuil de "
ANOMALY_SUFFIX = " km."

# Error text when the distances table has no usable distance.
NO_DISTANCE_ERROR = "distance unavailable"

# --- Benefit parameters -----------------------------------------------------
DEFAULT_PARAMETERS = [
    ("bonus_rate", "0.05"),
    ("wellness_days", "5"),
    ("min_annual_activities", "15"),
    ("max_walk_distance_km", "15"),
    ("max_cycle_distance_km", "25"),
]

# --- Data-quality rules -----------------------------------------------------
DQ01 = "DQ01_NEGATIVE_DISTANCE"
DQ02 = "DQ02_INVALID_DURATION"
DQ03 = "DQ03_MISSING_SPORT"
DQ04 = "DQ04_UNKNOWN_EMPLOYEE"
DQ05 = "DQ05_FUTURE_ACTIVITY"
DQ06 = "DQ06_UNEXPECTED_DISTANCE"
DQ07 = "DQ07_MISSING_DISTANCE"
DQ08 = "DQ08_INVALID_SPORT_NAME"

DQ01_MESSAGE = "La distance est négative."
DQ02_MESSAGE = "La date de fin est antérieure ou égale à la date de début."
DQ03_MESSAGE = "Le type de sport est vide."
DQ04_MESSAGE = "L'activité référence un employé inexistant."
DQ05_MESSAGE = "La date de début est dans le futur."
DQ06_PREFIX = "Distance renseignée pour un sport non kilométrique : "
DQ07_PREFIX = "Distance manquante pour un sport kilométrique : "
DQ08_MESSAGE = 'Le type de sport "Runing" doit être normalisé en "Running".'

# --- Notifications ----------------------------------------------------------
# "🏃 Bravo {name} ! Tu viens de terminer une activité {sport}"
# [" de {km:.1f} km"] [" en {minutes} min"] " ! 🔥🏅" ['\n💬 "{comment}"']
NOTIFY_PREFIX = "🏃 Bravo "
NOTIFY_MIDDLE = " ! Tu viens de terminer une activité "
NOTIFY_DISTANCE_PREFIX = " de "
NOTIFY_DISTANCE_SUFFIX = " km"
NOTIFY_DURATION_PREFIX = " en "
NOTIFY_DURATION_SUFFIX = " min"
NOTIFY_END = " ! 🔥🏅"
NOTIFY_COMMENT_PREFIX = '\n💬 "'
NOTIFY_COMMENT_SUFFIX = '"'
NOTIFY_UNKNOWN_EMPLOYEE = "Employé "
NOTIFY_DEFAULT_SPORT = "sport"
IGNORED_COMMENTS = ["Activité live simulée", "Historique simulé"]
LIVE_SOURCE = "live"

# --- Intake -----------------------------------------------------------------
REJECT_END_BEFORE_START = "end_at must be after start_at"
REJECT_UNKNOWN_EMPLOYEE = "employee_id inconnu"
REJECT_MISSING_FIELD = "missing required field"
REJECT_EMPTY_SPORT = "sport_type must have at least 1 character"
REJECT_NEGATIVE_DISTANCE = "distance_m must be greater than or equal to 0"

# --- Profiling --------------------------------------------------------------
EMPTY_LABEL = "(vide)"

# Anomaly report: indicator -> (severity, control label).
PROFILE_CONTROLS = [
    ("employees_duplicate_ids", "Critique", "Identifiants salariés en double"),
    ("sports_without_rh", "Majeure", "Lignes sport sans salarié RH"),
    ("rh_without_sports_row", "Mineure", "Salariés sans ligne sport"),
    ("sport_missing", "Information", "Salariés sans sport déclaré"),
    ("missing_addresses", "Majeure", "Adresses manquantes"),
    ("missing_commute", "Majeure", "Modes de déplacement manquants"),
    ("future_birth_dates", "Critique", "Dates de naissance dans le futur"),
    ("future_hire_dates", "Majeure", "Dates d'embauche dans le futur"),
    ("negative_salary", "Critique", "Salaires négatifs"),
]

# --- Text -------------------------------------------------------------------
# Characters Python's str.strip() removes (str.isspace), as one regex class
# written with \x{..} escapes so that Java regex and RE2 read it the same.
PY_WHITESPACE_CLASS = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
