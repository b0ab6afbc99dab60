"""Title overrides for industry and role. Fixed values."""

JUNK = (
    r"(survey\s*taker|paid\s+(for\s+)?surveys?|for\s+surveys?\b"
    r"|participat\w*\s+in\s+[^.]{0,30}?(survey|stud(y|ies)|trial|research)"
    r"|\b(online|medical|consumer|paid)\s+surveys?\b"
    r"|focus\s+group|research\s+(panelist|panellist|volunteer|participant)"
    r"|stud(y|ies)\s+participant|clinical\s+trial\s+(participant|volunteer)"
    r"|product\s+feedback\s+participant|market\s+research\s+participant"
    r"|\btask\s+reviewer\b|cashapp)"
)
JUNK_EXEMPT = (
    r"\b(nurse|rn|lpn|cna|driver|driving|drive|uber|lyft|doordash|instacart|courier"
    r"|delivery|trips?|cdl|engineer|developer|teacher|therapist|technician|assistant"
    r"|manager|analyst|specialist|coordinator|agent|caregiver|associate|clerk"
    r"|representative|supervisor|scientist|researcher)\b"
)
JUNK_CLASS = ("Business Services & Consulting", "Others")

# (pattern, industry, role)
TRAPS = [
    (r"\bdata\s+entry\b", "Business Services & Consulting", "Others"),
    (r"\bnon.?destructive\s+test|(\bndt\b)", "Manufacturing & Industrial", "Others"),
    (r"\b(cyber\s*security|information\s+security|infosec|security\s+(architect|engineer|analyst))\b", "Technology & IT", "Cybersecurity Specialist"),
]

LEADER = r"\b(director|vp|vice\s+president|head)\b"
# (pattern, industry, role); no role keeps the one already there.
LEADER_FUNCTIONS = [
    (r"\b(rehab|nursing|clinical|patient|medical|health)\b", "Healthcare & Caregiving", "Healthcare Professional"),
    (r"\b(engineering|software|technology|\bit\b)\b", "Technology & IT", None),
    (r"\b(finance|accounting|tax)\b", "Finance & Banking", "Accountant & Finance"),
    (r"\b(marketing|brand)\b", "Marketing & Media", "Marketing Specialist"),
]

REASON_JUNK = "junk-gig"
REASON_TRAP = "trap"
REASON_LEADER = "leader-function"
UNCLASSIFIED_ROLE = "Others"
