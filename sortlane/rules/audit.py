"""Audit rules: independent, deliberately narrow signals. Fixed values.

``*_NEEDS`` lists plain strings, one of which is part of every match of the pattern; the lists
of REMOTE and JOB_TYPE go with their rows in order.
"""

CONFLICT = "__CONFLICT__"
UNKNOWN = "__UNKNOWN__"

REMOTE = [
    ("Remote", r"\b(fully remote|100% remote|work from home|remote position)\b"),
    ("Hybrid", r"\bhybrid\b"),
    ("On-site", r"\b(on[- ]site|onsite|in office|office[- ]based)\b"),
]
REMOTE_NEEDS = [
    ["fully remote", "100% remote", "work from home", "remote position"],
    ["hybrid"],
    ["site", "office"],
]
JOB_TYPE = [
    ("Full-time", r"\bfull[- ]time\b"),
    ("Part-time", r"\bpart[- ]time\b"),
    ("Contract", r"\b(contract|contractor)\b"),
    ("Internship", r"\b(intern|internship)\b"),
    ("Temporary", r"\b(temporary|temp role)\b"),
]
JOB_TYPE_NEEDS = [
    ["full-time", "full time"],
    ["part-time", "part time"],
    ["contract"],
    ["intern"],
    ["temp"],
]
YEARS = r"\b(\d{1,2})\s*(?:\+|to\s*\d{1,2})?\s*years?\b"
COMPANY_AGE_PHRASES = ["founded", "in business", "serving clients", "company history"]
COMPANY_AGE_WINDOW = 35
ENTRY_UP_TO_YEARS = 1
MID_UP_TO_YEARS = 4
TITLE_EXPERIENCE = [
    ("Entry", r"\b(junior|jr\.?|entry[- ]level)\b"),
    ("Senior", r"\b(senior|sr\.?|lead|principal|director)\b"),
]
CLINICAL = (
    r"\b(nurse|physician|surgeon|therapist|pharmacist|medical assistant|dental hygienist|"
    r"caregiver|clinical technician|patient care)\b"
)
TRADES = (
    r"\b(driver|warehouse|forklift|welder|plumber|electrician|mechanic|laborer|labourer|"
    r"construction worker|carpenter|roofer|janitor|cleaner|security guard|assembler)\b"
)
AD_WORDS = r"\b(we are|you will|apply|benefits|401k|salary|equal opportunity|join our)\b"
AD_WORDS_NEEDS = [
    "we are",
    "you will",
    "apply",
    "benefits",
    "401k",
    "salary",
    "equal opportunity",
    "join our",
]
AD_MIN_CHARS = 900
