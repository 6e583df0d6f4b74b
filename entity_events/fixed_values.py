"""Names, words and limits that published rows must carry exactly.

Everything in this module is data that has to be equal for results to be right; no other
module spells these strings out.
"""

# Data stream naming.
STREAM_TYPE = "metrics"
DATASET_PREFIX = "homeassistant"
STREAM_NAMESPACE = "default"
STREAM_PATTERN = f"{STREAM_TYPE}-{DATASET_PREFIX}.*-{STREAM_NAMESPACE}"

# Field-name prefixes of the flat, dotted document.
TIMESTAMP_FIELD = "@timestamp"
ENTITY_FIELD = "hass.entity"
ATTRIBUTES_FIELD = ENTITY_FIELD + ".attributes"

# Reasons a reading is gathered, and the action text published for each.
STATE = "state"
ATTRIBUTE = "attribute"
POLLING = "polling"
ACTION_TEXT = {STATE: "State change", ATTRIBUTE: "Attribute change", POLLING: "Polling"}
EVENT_KIND = "event"
CHANGE_TYPE = "change"
POLL_TYPE = "info"

# Write operation of a published row.
CREATE = "create"

# Attributes that are published elsewhere in the document or not at all.
SKIPPED_ATTRIBUTES = (
    "friendly_name",
    "entity_picture",
    "icon",
    "device_class",
    "state_class",
    "unit_of_measurement",
)

# State words that stand for a boolean (case-sensitive).
TRUE_WORDS = ("true", "on", "locked", "above_horizon", "open", "home")
FALSE_WORDS = ("false", "off", "unlocked", "unknown", "below_horizon", "closed", "not_home")

# Limits of the published table.
DATASET_NAME_LIMIT = 128
KEYWORD_LIMIT = 1024
RETENTION_DAYS = 365
SCHEMA_VERSION = 6
