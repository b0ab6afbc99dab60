"""Table schemas, class vocabularies and the column names the engine works with."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: class vocabularies -------------------------------------------------

INDUSTRIES = [
    "Technology & IT",
    "Business Services & Consulting",
    "Healthcare & Caregiving",
    "Finance & Banking",
    "Retail & E-commerce",
    "Logistics & Transportation",
    "Construction & Real Estate",
    "Marketing & Media",
    "Education & Research",
    "Legal & Government",
    "Creative & Design",
    "Manufacturing & Industrial",
    "Hospitality & Travel",
    "Energy & Utilities",
    "Agriculture & Primary",
]

ROLES = [
    "Healthcare Professional",
    "Others",
    "Accountant & Finance",
    "Sales Representative",
    "Software Developer",
    "Construction & Real Estate",
    "Driver & Logistics",
    "Data Analyst",
    "Marketing Specialist",
    "Teacher & Educator",
    "Legal Professional",
    "Project Manager",
    "Consultant",
    "Executive",
    "Designer",
    "Customer Service Representative",
    "QA Engineer",
    "HR Specialist",
    "IT Specialist",
    "Product Manager",
    "Data Engineer",
    "DevOps Engineer",
    "Cybersecurity Specialist",
    "Data Scientist",
    "Machine Learning Engineer",
]

LEARNED_JOB_TYPES = ["Full-time", "Contract", "Part-time", "Internship", "Temporary"]
JOB_TYPES = LEARNED_JOB_TYPES + ["Per Diem"]
EXPERIENCE_LEVELS = ["Entry", "Mid", "Senior", "Executive"]
COLLARS = ["Blue", "White"]
REMOTE_MODES = ["On-site", "Remote", "Hybrid"]

# The six output columns, in output order.
TARGET_COLUMNS = [
    "industry",
    "role",
    "job_type",
    "experience_level",
    "collar",
    "remote_mode",
]

VOCABULARIES = {
    "industry": INDUSTRIES,
    "role": ROLES,
    "job_type": JOB_TYPES,
    "experience_level": EXPERIENCE_LEVELS,
    "collar": COLLARS,
    "remote_mode": REMOTE_MODES,
}

# Physical column names of the jobs table -> names used here.
JOBS_COLUMN_NAMES = {
    "category_name": "industry",
    "standard_role": "role",
    "jobType": "job_type_feed",
    "experienceLevel": "experience_level",
    "standard_role_method": "role_method",
    "standard_role_confidence": "role_confidence",
    "standard_role_updated_at": "role_updated_at",
    "classified_6col_at": "classified_at",
}

# --- Schemas --------------------------------------------------------------------------

JOBS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("remote", T.BooleanType()),
        T.StructField("job_type_feed", T.StringType()),
        T.StructField("experience_level", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("role_method", T.StringType()),
        T.StructField("role_confidence", T.DoubleType()),
        T.StructField("role_updated_at", T.TimestampType()),
        T.StructField("collar", T.StringType()),
        T.StructField("remote_mode", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("classified_at", T.TimestampType()),
    ]
)

POSTINGS_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "title",
            "description",
            "formatted_work_type",
            "formatted_experience_level",
            "remote_allowed",
        )
    ]
)

TRAINING_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("title", "description", "industry", "role")]
)

AUGMENTED_COLUMNS = [
    "title",
    "description",
    "industry",
    "role",
    "job_type",
    "experience_band",
    "remote_type",
    "collar",
]

UPDATE_SCHEMA = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("id", "industry", "role", "collar", "experience_level", "job_type")
    ]
)


def off_vocabulary(column: str):
    """True where a non-null value of an output column is outside its vocabulary."""
    from pyspark.sql import functions as F

    c = F.col(column)
    return c.isNotNull() & (c != "") & ~c.isin(VOCABULARIES[column])
