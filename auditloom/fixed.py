"""Values that results depend on and that callers may not change."""

# Job states.
QUEUED = "QUEUED"
PROCESSING = "PROCESSING"
PROCESSED = "PROCESSED"
FAILED_RETRY = "FAILED_RETRY"
FAILED_PERMANENT = "FAILED_PERMANENT"
DELETING = "DELETING"

# Reconcile outcomes.
OUTCOME_QUEUED = "queued"
OUTCOME_SKIPPED = "skipped"
OUTCOME_DEFERRED = "deferred_in_flight"

# Delete actions.
ACTION_DELETE = "delete"
ACTION_DEFER = "defer_in_flight"
ACTION_SKIP = "skip_stale_generation"

# Leases and retry limits.
MAX_ATTEMPTS = 5
RETRY_WINDOW = "10 minutes"
DELETE_WINDOW = "10 minutes"
IN_FLIGHT_WINDOW = "2 hours"
URL_LIFETIME = "7 days"
SCORE_ATTEMPTS = 4
MAX_ROW_BYTES = 9 * 1024 * 1024

# Object names.
URI_SCHEME = "gs://"
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png")
THUMB_BUCKET_SUFFIX = "-thumbnails"
THUMB_FOLDER = "thumbnails"
THUMB_ENDING = "_thumb.webp"
THUMB_BOX = 200

# Response and roll-up labels.
TOTAL_KEY = "TotalWeightLbs"
ROLLUP_CLASS = "Class"
FENCE_OPEN = "```json"
FENCE_CLOSE = "```"
UNKNOWN_MODEL = "unknown"

# Configuration sheets, keys and placeholders.
SHEETS = ("GeneralConfig", "ModelConfigs", "Materials")
GENERAL_KEYS = ("system_instruction_template", "user_prompt")
PLACEHOLDERS = (
    "{material_details}",
    "{material_densities_class}",
    "{detected_materials}",
)
DEFAULT_THINKING_LEVEL = "HIGH"

# Columns of the result and error tables. The name of the column
# holding the whole response is a parameter of `with_payload`.
RESULT_SCHEMA = (
    "image_id string, model_name string, prompt_version_id string, "
    "processing_timestamp timestamp, model_result string, class string, "
    "material string, estimated_percentage double, scaled_weight double, "
    "gcs_uri string, gcs_thumb_uri string, raw_signed_url string, "
    "thumb_signed_url string"
)
ERROR_SCHEMA = (
    "image_id string, model_name string, prompt_version_id string, "
    "error_timestamp timestamp, error_message string, gcs_uri string"
)
JOB_SCHEMA = (
    "gcs_uri string, prompt_version_id string, status string, "
    "queued_at timestamp, generation bigint, attempts bigint, "
    "last_processed_at timestamp, error_message string, deleting_at timestamp"
)

# Default taxonomy with densities in pounds per cubic yard.
DEFAULT_MATERIALS = (
    ("Paper", "Cardboard (unwaxed)", 106),
    ("Paper", "Mixed paper", 158),
    ("Paper", "Coated cartons and cups", 158),
    ("Paper", "Paper food serviceware", 138),
    ("Paper", "Compostable paper towels", 138),
    ("Plastic", "#1 & #2 HDPE containers", 35),
    ("Plastic", "#3-6 containers", 35),
    ("Plastic", "#7 PLA or PHA rigid plastics", 35),
    ("Plastic", "Other rigid plastics", 26),
    ("Plastic", "#7 PLA or PHA film plastics", 35),
    ("Plastic", "Latex/nitrile gloves", 35),
    ("Plastic", "Snack wrappers", 35),
    ("Plastic", "Film plastic", 23),
    ("Metal", "Aluminum cans", 46),
    ("Metal", "Other recyclable metals", 225),
    ("Glass", "Recyclable glass", 380),
    ("Glass", "Other glass", 999),
    ("Organics", "Food & liquids", 486),
    ("Organics", "Other compostable organics", 135),
    ("Other", "E-waste and batteries", 438),
    ("Other", "HHW", 1671),
    ("Other", "Operational waste (C&D, HVAC, furniture)", 417),
    ("Other", "Other residuals", 135),
)

# Texts a prompt template is filled with.
DENSITIES_HEADER = (
    "class MaterialDensitiesByClasses(TypedDict):\n"
    '    """\n'
    "    Density factors for materials, organized by classes.\n"
    '    """\n'
)
DETECTED_HEADER = (
    "class DetectedMaterials(TypedDict):\n"
    '    """\n'
    "    Detected materials, organized by classes and their respective percentage on the picture\n"
    '    """\n'
)
DENSITIES_FIELD = ": Dict[str, Material]"
DETECTED_FIELD = ": Dict[str, float]"
