"""Overrides for job type, experience, collar and remote mode. Fixed values.

``*_NEEDS`` lists plain strings, one of which is part of every match of the pattern above.
"""

PER_DIEM = r"\b(per\s*diem|perdiem|\bprn\b)\b"
PER_DIEM_NEEDS = ["diem", "prn"]
TRAVEL_CONTRACT = (
    r"\b(travel\s+(nurse|rn|allied|therap\w*|tech\w*|radiolog\w*|sonograph\w*"
    r"|contract|assignment|position)"
    r"|\d{1,2}\s*[- ]?week\s+(travel\s+)?(contract|assignment|position)"
    r"|locum\s*tenens?|\bcdd\b|contrat\s+.{0,6}dur.e\s+d.termin)\b"
)
TRAVEL_CONTRACT_NEEDS = ["travel", "week", "locum", "cdd", "contrat"]
GIG_PLATFORM = (
    r"\b(uber|lyft|doordash|instacart|grubhub|postmates|shipt|amazon\s*flex"
    r"|gopuff|spark\s+driver|favor|roadie)\b"
)
GIG_ACTIVITY = (
    r"\b(driv\w+|deliver\w+|courier|rideshare|ride\s*share|trips?|gig"
    r"|shopper|earn.{0,20}\bper\s+(hour|trip|delivery)\b)\b"
)
CONTRACT_SUBJECTS = (
    r"manager|management|administrat|admin|specialist|analyst|coordinator|attorney"
    r"|negotiat|officer|lead|director|counsel|clerk|assistant"
)
TITLE_JOB_TYPE = [
    ("Internship", r"\b(intern|internship|praktikant)\b"),
    ("Part-time", r"\bpart[\s-]?time\b"),
    ("Full-time", r"\bfull[\s-]?time\b"),
    ("Temporary", r"\b(temp|temporary|seasonal)\b"),
    ("Contract", r"\b(contractor|1099|c2c|corp[\s-]?to[\s-]?corp)\b"),
    ("Contract", rf"\bcontract\b(?!\s*({CONTRACT_SUBJECTS}))"),
]

TITLE_EXPERIENCE = [
    ("Senior", r"\b(vp|vice\s+president|svp|evp|head\s+of|director)\b"),
    ("Executive", r"\b(chief|\bc[etofi]o\b|founder|president)\b"),
    ("Senior", r"\b(principal|lead|senior|\bsr\.?\b)\b"),
    ("Entry", r"\b(junior|jr\.?|entry[\s-]?level|trainee|apprentice|intern|internship|graduate|new\s+grad)\b"),
]
YEARS = (
    r"(\d{1,2})\s*\+?\s*(?:to\s*\d{1,2}\s*)?years?"
    r"(?:['’]?\s*(?:of\s+)?(?:relevant\s+|related\s+|professional\s+|work(?:ing)?\s+"
    r"|industry\s+|hands[\s-]on\s+|prior\s+|direct\s+)*(?:experience|exp\b))"
)
ENTRY_UP_TO_YEARS = 2
MID_UP_TO_YEARS = 5
NO_EXPERIENCE = (
    r"\b(no\s+(prior\s+)?experience(\s+(needed|required|necessary))?"
    r"|entry[\s-]?level|will\s+train|no\s+degree\s+required|beginners?\s+welcome)\b"
)
NO_EXPERIENCE_NEEDS = ["experience", "entry", "train", "degree", "beginner"]

CLINICAL_TITLE = (
    r"\b(nurse|\brn\b|\blpn\b|\bcna\b|physician|surgeon|therapist|pharmacist"
    r"|medical\s+assistant|dental\s+hygienist|hygienist|radiolog\w*|sonograph\w*"
    r"|caregiver|caretaker|phlebotom\w*|paramedic|\bemt\b|patient\s+care|home\s+health)\b"
)
WHITE_TITLE = (
    r"\b(engineer|developer|programmer|architect|analyst|scientist|accountant"
    r"|bookkeeper|auditor|actuary|underwriter|controller|economist|consultant"
    r"|attorney|lawyer|paralegal|counsel|manager|director|planner|designer"
    r"|strategist|recruiter|marketer|financial\s+advisor)\b"
)
BLUE_TITLE = (
    r"\b(driver|driving|cdl|trucker|warehouse|forklift|welder|plumber|electrician"
    r"|mechanic|labou?rer|carpenter|roofer|janitor|custodian|cleaner|housekeep\w*"
    r"|security\s+guard|assembler|machinist|operator|technician|picker|packer"
    r"|landscap\w*|construction|maintenance|cook|chef|server|bartender|barista"
    r"|cashier|stocker|courier|delivery)\b"
)

REMOTE_TEXT = (
    r"\b(fully[\s-]remote|100%\s*remote|work\s+from\s+home|\bwfh\b|remote\s+position"
    r"|remote\s+role|work\s+remotely|remote[\s-]first|telecommut\w*"
    r"|from\s+the\s+comfort\s+of\s+your\s+home|distributed\s+team)\b"
)
REMOTE_TEXT_NEEDS = ["remote", "home", "wfh", "telecommut", "distributed"]
HYBRID_TEXT = r"\bhybrid\b"
HYBRID_TEXT_NEEDS = ["hybrid"]
PHYSICAL_TITLE = (
    r"\b(nurse|\brn\b|\bcna\b|\blpn\b|dental|hygienist|radiolog\w*|\bmri\b|\bct\b"
    r"|surgical|surgeon|therapist|patient|clinic|hospital|bedside|phlebotom\w*|paramedic"
    r"|driver|truck|\bcdl\b|warehouse|forklift|welder|plumber|electrician|mechanic"
    r"|carpenter|roofer|janitor|custodian|cleaner|housekeep\w*|cook|chef|server"
    r"|waiter|cashier|barista|stocker|picker|packer|construction|landscap\w*"
    r"|retail|store\s+associate|teacher|classroom|caregiver|security\s+guard)\b"
)
