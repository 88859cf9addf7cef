"""Reference values and tunable settings."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: these must stay as they are for results to match -----------------

# Merchant category code, label, risk.
MERCHANT_RISK = [
    ("5912", "pharmacy", 0.6),
    ("7995", "gambling", 0.9),
    ("6051", "crypto_exchange", 0.85),
    ("4829", "money_transfer", 0.8),
    ("6211", "securities_broker", 0.7),
    ("5999", "misc_retail", 0.4),
]
DEFAULT_MERCHANT_RISK = 0.1
HIGH_RISK_CATEGORIES = tuple(code for code, _, _ in MERCHANT_RISK)

# Country code, risk.
COUNTRY_RISK = [
    ("NG", 0.85), ("RO", 0.70), ("UA", 0.65), ("VN", 0.60),
    ("CN", 0.55), ("RU", 0.80), ("BR", 0.50), ("IN", 0.40),
    ("US", 0.10), ("GB", 0.12), ("DE", 0.10), ("FR", 0.11),
]
DEFAULT_COUNTRY_RISK = 0.3

AGENTS = ("velocity", "geolocation", "behavioral", "network")
LATENCY_BOUNDS_S = (0.005, 0.01, 0.025, 0.05, 0.1, 0.2, 0.5, 1.0)
SLA_MS = 200.0
EARTH_RADIUS_KM = 6371.0

# --- Settings: may be changed; their defaults are fixed values, too -------------------


@dataclass(frozen=True)
class ScoringConfig:
    """Thresholds (all strict ``>``) and points of the four rule sets."""

    count_1h: int = 10
    count_1h_points: float = 0.30
    count_24h: int = 50
    count_24h_points: float = 0.15
    # Hourly spend is compared with average amount x 24 x 3.
    hours_per_average: int = 24
    spend_multiple: int = 3
    spend_points: float = 0.25

    distance_km: float = 500.0
    distance_points: float = 0.40
    new_country_points: float = 0.25
    new_city_points: float = 0.10
    high_risk_countries: tuple[str, ...] = ()
    high_risk_country_points: float = 0.20

    deviation_high: float = 3.0
    deviation_high_points: float = 0.35
    deviation_mid: float = 2.0
    deviation_mid_points: float = 0.15
    night_ratio: float = 0.7
    night_points: float = 0.20
    high_risk_categories: tuple[str, ...] = HIGH_RISK_CATEGORIES
    category_points: float = 0.20

    ip_high: float = 0.8
    ip_high_points: float = 0.40
    ip_mid: float = 0.5
    ip_mid_points: float = 0.20
    new_device_points: float = 0.15
    linked_high: int = 3
    linked_high_points: float = 0.40
    linked_any: int = 0
    linked_any_points: float = 0.20

    # Rules that exist as documented signals only; off unless asked for.
    same_merchant_1h: int = 5
    same_merchant_points: float = 0.20
    burst_per_minute: float = 5.0
    burst_points: float = 0.25
    max_speed_kmh: float = 900.0

    confidence: dict = field(default_factory=lambda: {
        "velocity": 0.85, "geolocation": 0.80, "behavioral": 0.82, "network": 0.88,
    })


@dataclass(frozen=True)
class DecisionConfig:
    weights: dict = field(default_factory=lambda: {
        "velocity": 0.20, "geolocation": 0.25, "behavioral": 0.30, "network": 0.25,
    })
    default_weight: float = 0.25
    decline_at: float = 0.75
    review_from: float = 0.40
    critical_at: float = 0.90
    expected_agents: int = len(AGENTS)

    def __post_init__(self):
        # With a threshold above the review band, scores between the two would be approved.
        if not self.review_from < self.decline_at <= self.critical_at:
            raise ValueError("need review_from < decline_at <= critical_at")


@dataclass(frozen=True)
class VelocityConfig:
    short_s: int = 3_600
    long_s: int = 86_400


@dataclass(frozen=True)
class TrainingConfig:
    trees: int = 400
    depth: int = 6
    learning_rate: float = 0.05
    subsample: float = 0.8
    train_share: int = 80
    seed: int = 42
    min_rows: int = 1000
    min_fraud_rate: float = 0.001
    max_fraud_rate: float = 0.5
    min_auc: float = 0.90
