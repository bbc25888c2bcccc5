"""Values that results must agree on: thresholds, costs, texts and keyword lists."""

# Sensor limits used by the rolling violation counters.
VIOLATION_LIMITS = [
    ("engine_temperature", "high", 110.0),
    ("engine_temperature", "low", 80.0),
    ("oil_pressure", "high", 55.0),
    ("oil_pressure", "low", 25.0),
    ("battery_voltage", "low", 11.5),
]

# Sensor limits used when a reading is scored.
SCORING_TEMPERATURE_HIGH = 105.0
SCORING_OIL_LOW = 30.0
SCORING_BATTERY_LOW = 11.8

# Columns of a sensor reading.
NUMERIC_INPUTS = [
    "engine_temperature", "oil_pressure", "rpm", "fuel_consumption", "battery_voltage",
    "distance_km", "idle_time_minutes", "max_speed_kmh", "vehicle_age_days", "total_distance",
]
CRITICAL_INPUTS = ["engine_temperature", "oil_pressure", "battery_voltage"]
TARGETS = ["failure_in_next_7d", "failure_in_next_30d"]
SCORING_INPUTS = [
    "engine_temperature", "oil_pressure", "rpm", "battery_voltage", "distance_km",
    "idle_time_minutes", "max_speed_kmh", "vehicle_age_days", "total_distance",
]
SCORING_COLUMNS = [
    *SCORING_INPUTS, "engine_stress", "oil_temp_ratio", "daily_usage_intensity", "temp_high_violation",
    "oil_low_violation", "battery_low_violation",
]

# Probability edges and advice of the scoring service.
RISK_LEVELS = [(0.8, "CRITICAL"), (0.6, "HIGH"), (0.4, "MEDIUM")]
RISK_LEVEL_ELSE = "LOW"
LEVEL_ADVICE = {
    "CRITICAL": "IMMEDIATE MAINTENANCE REQUIRED. Schedule service within 24 hours.",
    "HIGH": "Schedule maintenance within 3 days. Monitor closely.",
    "MEDIUM": "Schedule maintenance within 7 days. Continue monitoring.",
    "LOW": "Continue normal operation. Next scheduled maintenance.",
}
ADVICE_ELSE = "Monitor vehicle parameters."
ISSUE_TEMPERATURE = "Check cooling system"
ISSUE_OIL = "Check oil level and pressure"
ISSUE_BATTERY = "Check battery and charging system"

# Costs of the three money models.
COSTS_EVALUATION = {"preventive": 500.0, "reactive": 2000.0, "false_alarm": 100.0, "missed": 5000.0}
COSTS_PLANNING = {"preventive": 500.0, "reactive": 2000.0, "false_alarm": 100.0,
                  "downtime_hour": 200.0, "downtime_hours": 24.0, "investment": 50000.0}
COSTS_TRAINING = {"unplanned": 5000.0, "planned": 1000.0, "saved": 4000.0}

# Service recommendations (issue, severity, text, cost, hours).
RECOMMEND_TEMPERATURE = ("High Engine Temperature", "High",
                         "Check cooling system, thermostat, and coolant levels", 250, 4)
RECOMMEND_OIL = ("Low Oil Pressure", "Critical",
                 "Check oil level, oil pump, and for leaks", 500, 8)
RECOMMEND_MILEAGE = ("High Mileage Maintenance", "Medium",
                     "Schedule comprehensive maintenance check", 800, 24)

# Keyword categories of features, in order of precedence.
IMPORTANCE_KEYWORDS = [
    ("Engine Parameters", ["rpm", "temp", "pressure", "fuel", "oil", "engine", "torque"]),
    ("Electrical System", ["voltage", "current", "battery", "sensor", "electrical"]),
    ("Usage Metrics", ["mileage", "distance", "hours", "speed", "usage", "trip"]),
    ("Time-based Features", ["age", "days", "months", "years"]),
]
IMPORTANCE_ELSE = "Other Features"
DASHBOARD_KEYWORDS = [
    ("Engine Temperature", ["temperature"]),
    ("Oil System", ["oil"]),
    ("Electrical System", ["battery"]),
    ("Usage Patterns", ["distance", "mileage"]),
    ("Historical Trends", ["rolling", "trend"]),
    ("Threshold Violations", ["violation"]),
]
DASHBOARD_ELSE = "Other Features"

# Importances shown when no model has been trained yet.
SAMPLE_IMPORTANCES = [
    ("engine_temperature_trend", 0.15, "Engine Temperature"),
    ("oil_pressure_violations", 0.12, "Oil System"),
    ("battery_voltage_min", 0.10, "Electrical System"),
    ("distance_7d_avg", 0.08, "Usage Patterns"),
    ("vehicle_age", 0.07, "Historical Trends"),
]

# Groups of metric names.
METRIC_CATEGORIES = [
    ("Accuracy", ["accuracy", "balanced_accuracy"]),
    ("Precision", ["precision", "average_precision"]),
    ("Recall", ["recall", "sensitivity", "detection_rate"]),
    ("False Positive Rate", ["false_positive_rate", "false_alarm_rate", "specificity"]),
    ("AUC", ["roc_auc"]),
]

# Units and categories of money metrics, by contained word, in order.
BUSINESS_UNITS = [("USD", ["cost", "savings"]), ("%", ["percentage"]), ("USD/vehicle", ["per_vehicle"])]
BUSINESS_CATEGORIES = [
    ("Cost Analysis", ["cost"]),
    ("Savings", ["savings"]),
    ("Maintenance Operations", ["maintenance"]),
    ("Risk Analysis", ["alarm", "failure"]),
]

# Documented features by category.
FEATURE_CATALOG = {
    "Engine Parameters": [
        "engine_temperature", "oil_pressure", "rpm", "engine_temperature_rolling_mean_7d",
        "oil_pressure_rolling_std_7d", "engine_stress", "oil_temp_ratio",
    ],
    "Electrical System": [
        "battery_voltage", "battery_voltage_roc", "battery_voltage_low_violations_7d",
    ],
    "Usage Patterns": [
        "distance_km", "idle_time_minutes", "max_speed_kmh", "distance_km_rolling_mean_7d",
        "fuel_efficiency", "speed_distance_interaction",
    ],
    "Historical Trends": [
        "vehicle_age_days", "total_distance", "days_since_last_maintenance", "age_usage_interaction",
    ],
    "Threshold Violations": [
        "engine_temperature_high_violations_7d", "oil_pressure_low_violations_7d",
    ],
    "Temporal Features": ["month", "day_of_week", "is_weekend", "day_sin", "day_cos"],
}

# Advice on evaluated models.
ADVICE_RECALL = ("Consider tuning the model to improve recall (reduce missed failures), "
                 "as these are costly in maintenance scenarios.")
ADVICE_PRECISION = ("The model has relatively high false alarms. Consider adjusting the "
                    "decision threshold or collecting more data on normal operation.")
ADVICE_ALARMS = ("The false alarm rate is high compared to true detections. "
                 "Review feature engineering and consider adding more contextual data.")
ADVICE_GOOD = ("The model performs well across both technical and business metrics. "
               "Proceed with deployment and monitor performance in production.")
