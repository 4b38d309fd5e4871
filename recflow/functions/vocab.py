"""Vocabularies and constants.

FIXED VALUES — these must equal the behaviour being reproduced, so they are
stated plainly and in their evaluation order.  Each keyword is a regex
fragment (``catch[- ]up`` accepts both spellings).
"""

# FIXED VALUES: routing rules in evaluation order (first match wins).
# (category, sync_blocked, keywords)
ROUTING_RULES = [
    ("Personal-Health", True, [
        "clinical", "doctor", "medical", "ultrasound", "appointment", "visit", "patient",
        "diagnosis", "prescription", "OB", "obstetric", "fetal", "pregnancy", "gynec"]),
    ("Casual", True, [
        "casual chat", "gathering", "family", "personal", "life plan", "date night",
        "hangout", "catch[- ]up"]),
    ("Learning", False, [
        "lecture", "course", "training", "tutorial", "webinar", "workshop", "class", "seminar"]),
    ("Business", False, [
        "strategy", "project", "meeting", "scoping", "consultation", "discovery", "business",
        "client", "proposal", "onboarding", "kickoff", "standup", "review", "integration",
        "deployment", "automation", "pipeline", "product demo", "onsultation"]),
]

# FIXED VALUES: fallback bucket and its flag.
FALLBACK_CATEGORY = "_unclassified"
FALLBACK_BLOCKED = False

# FIXED VALUES: categories a model verdict may name, in the order the
# substring fallback tries them; and the two sync-blocked categories.
VALID_CATEGORIES = ["Personal-Health", "Casual", "Learning", "Business"]
SYNC_BLOCKED = ["Personal-Health", "Casual"]

# FIXED VALUES: buckets scanned by enrichment, categories that get action items,
# and the delivery-signal phrases (whole words, case-insensitive).
BUCKETS = ["Business", "Personal-Health", "Learning", "Casual", "_unclassified"]
ACTION_CATEGORIES = ["Business", "Personal-Health"]
DELIVERY_SIGNALS = [
    "closed", "shipped", "delivered", "wrapped", "live", "launched", "signed", "deployed",
    "in production", "went live"]

# FIXED VALUES: entity types in load order (earlier type wins a case-insensitive
# name clash) and the minimum name length (names of <= 3 characters are dropped).
ENTITY_TYPES = ["People", "Companies", "Projects"]
ENTITY_MIN_LEN_EXCLUSIVE = 3

# FIXED VALUES: the original's size limits.  Except for the slug and the short id,
# which are labels, they are opt-in arguments: by default nothing is cut.
SUMMARY_EXCERPT_CHARS = 1500
SEARCH_TRANSCRIPT_CHARS = 8000
DELIVERY_TRANSCRIPT_CHARS = 4000
SLUG_MAX_CHARS = 60
SHORT_ID_CHARS = 8
REASON_MAX_CHARS = 200
UNPARSEABLE_ECHO_CHARS = 80
DEFAULT_RECLASS_MAX = 50

# FIXED VALUES: action-item section headings.
# Pattern A: a heading of two or more '#', optionally quoted, then one of the
# words; pattern B: a bullet label ending in ':' (no To-Do form).
ACTION_HEADING_WORDS_A = ["Plan", "Next Steps?", "Action Items?", "To-?Do"]
ACTION_HEADING_WORDS_B = ["Plan", "Next Steps?", "Action Items?"]
ACTION_NOISE_PLACEHOLDER = "insert more"
ACTION_MIN_CHARS = 8

# FIXED VALUES: model-verdict fallbacks.
PARSE_FALLBACK_CONFIDENCE = 0.5
PARSE_FALLBACK_REASON = "JSON parse fallback"
UNPARSEABLE_CATEGORY = "Business"
UNPARSEABLE_PREFIX = "unparseable: "
NO_SUMMARY_PLACEHOLDER = "(no summary available)"

# Document status values.
STATUS_UNTRIAGED = "untriaged"
STATUS_ROUTED = "routed"
STATUS_ENRICHED = "enriched"
