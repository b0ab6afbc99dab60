"""Remote-mode signals of the fill step and of the training labels. Fixed values.

``*_NEEDS`` lists plain strings, one of which is part of every match of the pattern.
"""

# Fill step: lower-cased text.
FILL_REMOTE = (
    r"(fully[ -]remote|100% *remote|work from home|\bwfh\b|remote position|work remotely"
    r"|telecommut|remote[ -]first)"
)
FILL_REMOTE_NEEDS = ["remote", "home", "wfh", "telecommut"]
FILL_HYBRID = r"\bhybrid\b"
FILL_CHUNK_ROWS = 30000

# Training labels: title and description, any case.
LABEL_SIGNALS = [
    (
        "Remote",
        r"\b(fully[- ]remote|100%\s*remote|work from home|remote position|remote role|"
        r"telecommute|telecommuting|work remotely|remote[- ]first)\b",
    ),
    (
        "Hybrid",
        r"\b(hybrid(\s+(work|schedule|model|role|position|arrangement))?|"
        r"\d\s*days?\s+(in|at)\s+(the\s+)?office|partially remote|split between home and office)\b",
    ),
    (
        "On-site",
        r"\b(on[- ]site|onsite|in[- ]office|office[- ]based|in person|"
        r"must be (located|based) (in|at)|no remote|not a remote)\b",
    ),
]
LABEL_NEEDS = [
    ["remote", "home", "telecommut"],
    ["hybrid", "office", "partially remote"],
    ["site", "office", "person", "must be", "remote"],
]
