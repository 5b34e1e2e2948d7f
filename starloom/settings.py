"""Business parameters and the fixed values every rule shares."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

# Order status codes as the source systems write them.
STATUS_CODES = {
    "livré": "livré",
    "livre": "livré",
    "LIVRE": "livré",
    "DONE": "livré",
    "annulé": "annulé",
    "annule": "annulé",
    "KO": "annulé",
    "en_cours": "en_cours",
    "OK": "en_cours",
    "retourné": "retourné",
    "retourne": "retourné",
}
DELIVERED = "livré"
RETURNED = "retourné"
UNKNOWN_STATUS = "inconnu"
STATUSES = ("livré", "annulé", "en_cours", "retourné", "inconnu")

# Sex codes after trimming and lower-casing.
SEX_CODES = {
    "m": "m",
    "male": "m",
    "homme": "m",
    "h": "m",
    "1": "m",
    "f": "f",
    "female": "f",
    "femme": "f",
    "0": "f",
}
UNKNOWN_SEX = "inconnu"

# Left-closed age bands as (upper bound, label); the last band is open.
AGE_BANDS = (
    (18, "<18"),
    (25, "18-24"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (65, "55-64"),
    (None, "65+"),
)

# Fixed value: accepted e-mail form. \z refuses a trailing newline.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}\z"

SEGMENTS = ("Gold", "Silver", "Bronze")
UNKNOWN_CITY = "Non renseignée"
UNKNOWN_COURIER = "-1"

# Misspelled and short city names met in the sources.
CITY_EXTRAS = {
    "tnja": "Tanger",
    "tng": "Tanger",
    "casa": "Casablanca",
    "casablanca ": "Casablanca",
    "rbat": "Rabat",
    "fes": "Fès",
    "fez": "Fès",
    "mrakech": "Marrakech",
    "marrakesh": "Marrakech",
    "agdir": "Agadir",
    "meknes": "Meknès",
    "kenitra": "Kenitra",
    "kénitra": "Kenitra",
    "tetouan": "Tétouan",
    "beni mellal": "Béni Mellal",
    "eljadida": "El Jadida",
}

# Calendar names.
DAY_NAMES = ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche")
MONTH_NAMES = (
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
)

# Public holidays 2020-2025.
HOLIDAYS = (
    "2020-01-01", "2020-01-11", "2020-05-01", "2020-07-30", "2020-08-14",
    "2020-08-20", "2020-08-21", "2020-11-06", "2020-11-18",
    "2021-01-01", "2021-01-11", "2021-05-01", "2021-07-30", "2021-08-14",
    "2021-08-20", "2021-08-21", "2021-11-06", "2021-11-18",
    "2022-01-01", "2022-01-11", "2022-05-01", "2022-07-30", "2022-08-14",
    "2022-08-20", "2022-08-21", "2022-11-06", "2022-11-18",
    "2023-01-01", "2023-01-11", "2023-05-01", "2023-07-30", "2023-08-14",
    "2023-08-20", "2023-08-21", "2023-11-06", "2023-11-18",
    "2024-01-01", "2024-01-11", "2024-05-01", "2024-07-30", "2024-08-14",
    "2024-08-20", "2024-08-21", "2024-11-06", "2024-11-18",
    "2025-01-01", "2025-01-11", "2025-05-01", "2025-07-30", "2025-08-14",
    "2025-08-20", "2025-08-21", "2025-11-06", "2025-11-18",
)

# Ramadan periods 2020-2025, both ends included.
RAMADAN = (
    ("2020-04-24", "2020-05-23"),
    ("2021-04-13", "2021-05-12"),
    ("2022-04-02", "2022-05-01"),
    ("2023-03-22", "2023-04-20"),
    ("2024-03-10", "2024-04-09"),
    ("2025-03-01", "2025-03-29"),
)

# Placeholder courier attributes (no source carries them).
TRANSPORTS = ("Moto", "Véhicule léger", "Camionnette")
ZONES = ("Nord", "Centre", "Sud", "Est", "Ouest", "Centre-Nord", "Centre-Sud")

OPEN_END = date(9999, 12, 31)


@dataclass(frozen=True)
class Settings:
    """Everything a run may vary. Defaults are the business values."""

    as_of: date = date(2026, 6, 1)
    gold_from: Decimal = Decimal("15000")
    silver_from: Decimal = Decimal("5000")
    revenue_window_days: int = 365
    calendar_start: date = date(2020, 1, 1)
    calendar_end: date = date(2025, 12, 31)
    vat: Decimal = Decimal("0.20")
    max_delay_days: int = 60
    late_after_days: int = 3
    min_age: int = 16
    max_age: int = 100
    red_above: Decimal = Decimal("5.0")
    orange_above: Decimal = Decimal("3.0")
    top_city: str = "Tanger"
    top_k: int = 10
    period_category: str = "Alimentation"
    country: str = "Maroc"
    unresolved_sk: int = 1
    # A lookup is broadcast only when its counted rows stay under this bound. Its
    # few columns are keys and names of at most 200 characters.
    broadcast_rows: int = 1_000_000
    # One task ranks a whole group only when groups are proven smaller than this.
    rank_group_rows: int = 2_000_000
