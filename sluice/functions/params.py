"""Parameters with provenance, and lookup tables as small dimension tables."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Param:
    name: str
    value: float
    unit: str
    status: str  # sourced, derived or assumed
    source: str


# Rates, thresholds and weights of the model.
PARAMS = [
    Param("desilt_cost_per_km", 239_644, "INR/km", "derived", "Rs 53 crore over 2211.63 km, Deccan Chronicle, 18 August 2019"),
    Param("paddy_msp", 2_369, "INR/quintal", "sourced", "minimum support price, Kharif 2025-26, PIB release 2131983"),
    Param("paddy_yield", 3.45, "t/ha", "derived", "2.31 t/ha of milled rice, 67 kg from 100 kg of paddy"),
    Param("cropping_intensity", 1.0, "seasons/year", "assumed", "one season"),
    Param("target_health", 0.95, "share", "assumed", "health after cleaning"),
    Param("service_distance", 2_000, "m", "assumed", "reach of a segment"),
    Param("betweenness_weight", 1.0, "factor", "assumed", "weight of centrality in the priority"),
    Param("budget", 50_000_000, "INR", "assumed", "default budget"),
    Param("trials", 200, "runs", "assumed", "runs of the baseline"),
]
VALUES = {p.name: p.value for p in PARAMS}

# Cost multipliers by canal type.
COST_MULTIPLIER = {"Main Canal": 2.0, "Branch Canal": 1.5, "Distributary": 1.0, "Minor": 0.7, "Sub Minor": 0.5, "Sub Sub Minor": 0.4, "Water Course": 0.4, "Feeder": 1.5}

# Order in which canal types serve a cell.
SERVICE_RANK = {"Sub Sub Minor": 0, "Sub Minor": 1, "Minor": 2, "Water Course": 2, "Distributary": 3, "Branch Canal": 4, "Main Canal": 5, "Feeder": 6}
OTHER_RANK = 9

# INR per tonne harvested.
CROP_PRICE = {
    "Rice": 23690, "Jowar": 36990, "Bajra": 27750, "Maize": 24000, "Ragi": 48860, "Arhar/Tur": 80000, "Other Pulses": 78000,
    "Groundnut": 72630, "Sunflower": 77210, "Sesamum": 98460, "Other Oilseeds": 75000, "Cotton": 77100, "Sugarcane": 3550,
    "Tobacco": 60000, "Fodder Crops": 3000, "Other Non Food Crops": 20000, "Other Food Crops": 20000, "Soyabean": 53280, "Gram": 58000,
}
# Tonnes harvested per hectare.
CROP_YIELD = {
    "Rice": 3.45, "Jowar": 1.2, "Bajra": 1.5, "Maize": 5.5, "Ragi": 2.2, "Arhar/Tur": 0.9, "Other Pulses": 0.7,
    "Groundnut": 2.2, "Sunflower": 1.2, "Sesamum": 0.6, "Other Oilseeds": 1.2, "Cotton": 0.55, "Sugarcane": 100.0,
    "Tobacco": 1.5, "Fodder Crops": 30.0, "Other Non Food Crops": 2.0, "Other Food Crops": 2.0, "Soyabean": 1.1, "Gram": 1.0,
}
# Crop of the production table -> crop of the water table.
WATER_KEY = {
    "Rice": "rice", "Jowar": "sorghum", "Bajra": "pearl millet", "Maize": "maize", "Ragi": "ragi", "Arhar/Tur": "redgram",
    "Other Pulses": "blackgram", "Groundnut": "groundnut", "Sunflower": "sunflower", "Sesamum": "gingely", "Other Oilseeds": "castor",
    "Cotton": "cotton", "Sugarcane": "sugarcane", "Tobacco": "tobacco", "Fodder Crops": "fodder cholam", "Soyabean": "soyabean", "Gram": "bengalgram",
}
# The district of a segment without one, of a project, and other spellings.
DEFAULT_DISTRICT = "THANJAVUR"
PROJECT_DISTRICT = {
    "Pullambadi Canal": "TIRUCHIRAPPALLI", "Kattalai": "KARUR", "Cauvery Mettur": "TIRUCHIRAPPALLI", "Cauvery Delta System": "THANJAVUR",
    "Lower Colleron Anicut System": "NAGAPATTINAM", "Nandhiyar Channel": "THANJAVUR", "Pelandhurai Anicut System": "TIRUCHIRAPPALLI",
}
DISTRICT_ALIAS = {
    "TIRUCHCHIRAPPALLI": "TIRUCHIRAPPALLI", "TIRUCHIRAPALLI": "TIRUCHIRAPPALLI", "THIRUVARUR": "THIRUVARUR", "TIRUVARUR": "THIRUVARUR",
    "NAGAPPATTINAM": "NAGAPATTINAM", "MAYILADUTHURAI": "NAGAPATTINAM", "KARAIKAL": "NAGAPATTINAM",
}
# Classes of a labelled point, and those that count as impaired.
LABEL_CLASSES = ["flowing", "dry", "choked", "encroached", "unclear"]
IMPAIRED = ["choked", "encroached"]


def params(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([asdict(p) | {"value": float(p.value)} for p in PARAMS], "name string, value double, unit string, status string, source string")


def mapping(spark: SparkSession, d: dict, key: str, value: str) -> DataFrame:
    """A lookup table of a dict: two columns, at most a few dozen rows."""
    kind = "string" if isinstance(next(iter(d.values())), str) else "double"
    return spark.createDataFrame([(k, v if kind == "string" else float(v)) for k, v in d.items()], f"{key} string, {value} {kind}")
