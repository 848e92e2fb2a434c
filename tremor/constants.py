"""Results depend on every one of them.

Boxes are (name or value, min lon, max lon, min lat, max lat), tested in order,
both ends included; the first match wins.
"""

REGION_BOXES = (
    ("Sumatra", 95, 106, -6, 6),
    ("Java", 106, 115, -9, -5),
    ("Kalimantan", 108, 117, -4, 5),
    ("Sulawesi", 118, 125, -6, 2),
    ("Eastern_Indonesia", 125, 141, -11, 2),
)
REGION_DEFAULT = "Other"

ZONE_BOXES = (
    ("indonesia", 95, 141, -11, 6),
    ("japan", 129, 146, 24, 46),
    ("philippines", 116, 127, 5, 19),
    ("chile", -76, -66, -56, -17),
)
ZONE_DEFAULT = "other"

TECTONIC_BOXES = (
    ("subduction_zone", 95, 141, -11, 6),
    ("transform_fault", -180, -60, -60, 60),
    ("volcanic_arc", 120, 160, -10, 50),
)
TECTONIC_DEFAULT = "intraplate"

REGIONAL_RISK_BOXES = (
    (0.9, 120, 160, -10, 50),
    (0.8, -180, -120, -60, 60),
    (0.95, 95, 141, -11, 6),
)
REGIONAL_RISK_DEFAULT = 0.3

POPULATION_DENSITY_BOXES = (
    (1000, 106, 115, -9, -5),
    (6000, 139, 141, 35, 36),
    (3000, -118, -117, 33, 34),
)
POPULATION_DENSITY_DEFAULT = 100

# Right-closed bins with the lowest edge included: (edges, labels).
MAGNITUDE_CLASS_BINS = ((0, 3, 4, 5, 6, 7, 10), ("Very Minor", "Minor", "Light", "Moderate", "Strong", "Major"))
MAGNITUDE_HAZARD_BINS = ((0, 4, 5, 6, 7, 10), ("Low", "Moderate", "Strong", "Major", "Great"))
DEPTH_CLASS_BINS = ((0, 30, 70, 300, 700), ("Very Shallow", "Shallow", "Intermediate", "Deep"))

# Left-closed upper limits; the last label has no limit.
MAGNITUDE_LEVELS = (
    (3, "micro"), (4, "minor"), (5, "light"), (6, "moderate"), (7, "strong"), (8, "major"), (None, "great"),
)
# Right-closed upper limits.
DEPTH_LEVELS = (
    (10, "very_shallow"), (30, "shallow"), (70, "intermediate_shallow"), (150, "intermediate"),
    (300, "intermediate_deep"), (500, "deep"), (None, "very_deep"),
)
MAGNITUDE_SPLITS = (0.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, float("inf"))
DEPTH_SPLITS = (0.0, 10.0, 30.0, 70.0, 150.0, 300.0, 500.0, float("inf"))

JAKARTA = (-6.2088, 106.8456)
KM_PER_DEGREE = 111
RING_OF_FIRE_POINT = (35.0, 140.0)
RING_OF_FIRE_AXES = (-5, 120)

ALERT_LEVELS = {"green": 1, "yellow": 2, "orange": 3, "red": 4}
ALERT_RISK = {"red": 1.0, "orange": 0.7, "yellow": 0.4}
ALERT_RISK_DEFAULT = 0.1
ALERT_INTENSITY = {"green": 0.2, "yellow": 0.5, "orange": 0.8, "red": 1.0}

ZONE_IMPACT = {"indonesia": 1000, "japan": 800, "philippines": 600}
ZONE_IMPACT_DEFAULT = 200
ZONE_ACTIVITY = {"indonesia": 0.95, "japan": 0.90, "philippines": 0.85, "chile": 0.80}
ZONE_ACTIVITY_DEFAULT = 0.30
REGION_HAZARD = {
    "Java": 2.0, "Sumatra": 1.5, "Sulawesi": 1.0, "Eastern_Indonesia": 0.5, "Kalimantan": 0.3, "Other": 0.0,
}

# Stepped intensity points: (at least, points), highest first.
FELT_STEPS = ((1000, 3), (100, 2), (10, 1))
INTENSITY_STEPS = ((8, 4), (6, 3), (4, 2), (2, 1))

SEASONS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "autumn": (9, 10, 11)}
LOCAL_ZONE = "Asia/Jakarta"

# Risk rule on a cluster's strongest event: (at least, zone).
CLUSTER_RISK_STEPS = ((6.5, "Extreme"), (5.5, "High"), (4.5, "Moderate"))
CLUSTER_RISK_DEFAULT = "Low"
HIGH_RISK = ("High", "Extreme")

DBSCAN_EPS = 0.004
DBSCAN_EPS_REGIONAL = 0.1
DBSCAN_MIN_SAMPLES = 5
GRID_SIZE = 0.1
DEFAULT_CONFIDENCE = 0.95
MODEL_VERSION = "1.0.0"
VOLUME_TARGET_MB = 64
