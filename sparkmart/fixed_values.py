"""Word lists, lookup tables, patterns and thresholds.

Results depend on these exact values, so they are stated here as plain text
and nowhere else.  Everything is a default: ``settings`` wraps them and every
operator takes its table as a parameter.
"""

# --- fixed values: sources -------------------------------------------------
NULL_TOKENS = ["NULL", "null", "NaN", "nan", "N/A", "n/a"]

# --- fixed values: warehouse standardisation tables ------------------------
ORDER_STATUSES = {
    "livré": "livré", "livre": "livré", "LIVRE": "livré",
    "DONE": "livré", "Livré": "livré", "livree": "livré",
    "annulé": "annulé", "annule": "annulé", "KO": "annulé",
    "Annulé": "annulé", "ANNULE": "annulé",
    "en_cours": "en_cours", "OK": "en_cours", "EN_COURS": "en_cours",
    "retourné": "retourné", "retourne": "retourné", "RETOURNE": "retourné",
}
DELIVERED = "livré"
UNKNOWN_STATUS = "inconnu"

SEXES = {
    "m": "m", "M": "m", "1": "m", "homme": "m", "Homme": "m",
    "HOMME": "m", "male": "m", "Male": "m", "h": "m", "H": "m",
    "f": "f", "F": "f", "0": "f", "femme": "f", "Femme": "f",
    "FEMME": "f", "female": "f", "Female": "f",
}
UNKNOWN_SEX = "inconnu"

CATEGORIES = {
    "electronique": "Electronique", "ELECTRONIQUE": "Electronique", "Electronique": "Electronique",
    "mode": "Mode", "MODE": "Mode", "Mode": "Mode",
    "alimentation": "Alimentation", "ALIMENTATION": "Alimentation", "Alimentation": "Alimentation",
}

CITY_VARIANTS = {
    "tng": "Tanger", "tnja": "Tanger", "tanger": "Tanger",
    "casa": "Casablanca", "cas": "Casablanca", "casablanca": "Casablanca",
    "mrakch": "Marrakech", "marrakesh": "Marrakech",
    "fez": "Fès", "fes": "Fès",
    "rabat": "Rabat",
    "agadir": "Agadir",
    "oujda": "Oujda",
    "meknes": "Meknès", "meknas": "Meknès",
    "kenitra": "Kénitra",
    "tetouan": "Tétouan", "tetuan": "Tétouan",
}
UNKNOWN_CITY = "Non renseignée"
CITY_ACCENTS = "éèêàâôûï"
CITY_ACCENTS_PLAIN = "eeeaaoui"

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
AGE_EDGES = [0, 18, 25, 35, 45, 55, 65, 200]
AGE_LABELS = ["<18", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
UNKNOWN_AGE = "Inconnu"
AGE_MIN, AGE_MAX = 16, 100

VAT_RATE = "0.20"
GOLD_FROM, SILVER_FROM = 15000, 5000
SEGMENT_DAYS = 365
LATE_AFTER_DAYS = 3
DEFAULT_PRICE = "0.01"
MISSING_COURIER = "-1"
END_OF_TIME = "9999-12-31"

# --- fixed values: calendar ------------------------------------------------
CALENDAR_START, CALENDAR_END = "2020-01-01", "2026-12-31"
HOLIDAY_MONTH_DAYS = ["01-01", "01-11", "05-01", "07-30", "08-14", "11-06", "11-18"]
HOLIDAY_YEARS = (2022, 2026)
RAMADAN_PERIODS = [
    ("2020-04-23", "2020-05-23"),
    ("2021-04-12", "2021-05-12"),
    ("2022-04-02", "2022-05-01"),
    ("2023-03-22", "2023-04-20"),
    ("2024-03-10", "2024-04-09"),
    ("2025-03-01", "2025-03-30"),
    ("2026-02-17", "2026-03-18"),
]

# --- fixed values: dimension members ---------------------------------------
COUNTRY = "Maroc"
UNKNOWN_MEMBER = "Inconnu"
COURIER_TRANSPORTS = ["Camionnette", "Moto", "Vélo électrique", "Voiture"]
COURIER_ZONES = [
    "Tanger Nord", "Tanger Sud", "Casablanca Centre", "Casablanca Est",
    "Rabat", "Marrakech", "Fès", "Agadir", "National",
]

# --- fixed values: lake ----------------------------------------------------
# Ordered rules on the trimmed, lower-case job title; the last match wins.
PROFILE_RULES = [
    (r"data\s*eng(ineer|ineer\w*|\.)?|ingénieur\s+data|dev\s+data\s+eng", "Data Engineer"),
    (r"etl\s*dev|pipeline\s*dev|ingénieur\s+etl", "Data Engineer"),
    (r"data\s*anal(yst|yste|ytics)|analyste?\s+data|bi\s+anal", "Data Analyst"),
    (r"business\s+intel(ligence)?|ingénieur\s+bi|développeur\s+bi", "Data Analyst"),
    (r"data\s*sci(entist|ence)|machine\s*learn|ml\s*eng|ia\s*eng", "Data Scientist"),
    (r"full\s*stack|fullstack", "Développeur Full Stack"),
    (r"back[\s-]*end|backend", "Développeur Backend"),
    (r"front[\s-]*end|frontend", "Développeur Frontend"),
    (r"devops|sre|site\s*reliab", "DevOps / SRE"),
]
OTHER_PROFILE = "Autre IT"

SALARY_UNKNOWN = ["null", "confidentiel", "selon profil", ""]
SALARY_DROP = ["eur", "€", "mad", "dh"]
SALARY_EUR_MARKS = ["eur", "€"]
EUR_TO_MAD = 10.8
SALARY_FLOOR, SALARY_CEILING = 3000, 100000

JUNIOR_WORDS = ["débutant", "junior", "stage", "sans expérience"]
SENIOR_WORDS = ["senior", "confirmé", "expert", "lead"]
JUNIOR_YEARS = (0, 2)
SENIOR_YEARS_FROM = 5
YEARS_RANGE_PATTERN = r"(?U)([0-9]+)\s*[-àa]\s*([0-9]+)"
YEARS_FROM_PATTERN = r"(?U)([0-9]+)\s*(?:ans?|years?)"

REMOTE_WORDS = ["télétravail", "remote", "hybride"]
UNKNOWN_FIELD = "Inconnu"
UNKNOWN_SOURCE = "inconnu"
UNKNOWN_MONTH = "date_inconnue"
NO_SKILL, NO_FAMILY = "non_détecté", "inconnu"
