"""Lookup tables from source values to labels, and curation constants. Fixed values."""

BLUE_ROLES = ["Healthcare Professional", "Driver & Logistics", "Construction & Real Estate"]
WHITE_ROLES = [
    "Software Developer",
    "Data Analyst",
    "Data Scientist",
    "Data Engineer",
    "Machine Learning Engineer",
    "DevOps Engineer",
    "IT Specialist",
    "QA Engineer",
    "Cybersecurity Specialist",
    "Product Manager",
    "Designer",
    "Marketing Specialist",
    "Sales Representative",
    "HR Specialist",
    "Accountant & Finance",
    "Consultant",
    "Project Manager",
    "Teacher & Educator",
    "Executive",
    "Customer Service Representative",
    "Legal Professional",
]

REMOTE_FLAGS = ["1.0", "1"]

# Source work type -> job type; the two without a counterpart have no label.
JOB_TYPE = {
    "Full-time": "Full-time",
    "Contract": "Contract",
    "Part-time": "Part-time",
    "Internship": "Internship",
    "Temporary": "Temporary",
    "Other": None,
    "Volunteer": None,
}
EXPERIENCE_4 = {
    "Internship": "Entry",
    "Entry level": "Entry",
    "Associate": "Mid",
    "Mid-Senior level": "Mid",
    "Director": "Senior",
    "Executive": "Executive",
}
EXPERIENCE_3 = {
    "Internship": "Entry",
    "Entry level": "Entry",
    "Associate": "Mid-Senior",
    "Mid-Senior level": "Mid-Senior",
    "Director": "Senior",
    "Executive": "Senior",
}

ROWS_PER_GROUP = 2
CLASS_FLOOR = {"industry": 5, "role": 5}
DEFAULT_CLASS_FLOOR = 30

FOLDS = 5
CALIBRATION_FOLDS = 3
CALIBRATION_FRACTION = 0.20
MIN_CALIBRATION_ROWS = 200
SPLIT_SEED = 42

TARGET_PRECISION = 0.95
GATE_FIRST_MILLI = 200
GATE_STEP_MILLI = 5
GATE_CUTS = 160
MIN_KEPT_OUT_OF_FOLD = 200
MIN_KEPT_HELD_OUT = 100

NGRAM_MIN_DF = 3
NGRAM_MAX_FEATURES = 40000
SVM_C = 2.0
SVM_MAX_ITER = 3000
