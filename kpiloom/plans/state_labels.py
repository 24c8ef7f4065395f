"""The state's student groups: standard labels, spellings by year, validation lists."""

from __future__ import annotations

from kpiloom.operators.demographics import DemographicDims

# The labels that every export is brought to.
STANDARD = [
    "All Students", "Female", "Male", "African American", "American Indian or Alaska Native", "Asian", "Hispanic or Latino",
    "Native Hawaiian or Pacific Islander", "Two or More Races", "White (non-Hispanic)", "Economically Disadvantaged",
    "Non-Economically Disadvantaged", "English Learner", "Non-English Learner", "English Learner including Monitored",
    "Non-English Learner or monitored", "Foster Care", "Non-Foster Care", "Homeless", "Non-Homeless", "Migrant", "Non-Migrant",
    "Students with Disabilities (IEP)", "Students without IEP", "Military Dependent", "Non-Military", "Non-Military Dependent",
    "Gifted and Talented", "Non-Gifted and Talented", "Consolidated Student Group", "Alternate Assessment",
    "Students with Disabilities/IEP Regular Assessment", "Students with Disabilities/IEP with Accommodations",
    "Students with Disabilities/IEP without Accommodations",
]
# Spellings of any year, in order (the first of equal ones without case counts).
GENERAL = [
    ("Non Economically Disadvantaged", "Non-Economically Disadvantaged"),
    ("Non English Learner", "Non-English Learner"),
    ("Non-Foster", "Non-Foster Care"),
    ("Student without Disabilities (IEP)", "Students without IEP"),
    ("Students with Disabilities/IEP Regular Assessment", "Students with Disabilities/IEP Regular Assessment"),
    ("Students with Disabilities/IEP with Accommodations", "Students with Disabilities/IEP with Accommodations"),
    ("Students with Disabilities/IEP without Accommodations", "Students with Disabilities/IEP without Accommodations"),
    ("Non-Gifted and Talented", "Non-Gifted and Talented"),
    ("Non-Military Dependent", "Non-Military Dependent"),
    ("White (Non Hispanic)", "White (non-Hispanic)"),
    ("all students", "All Students"),
    ("female", "Female"),
    ("male", "Male"),
    ("african american", "African American"),
    ("american indian or alaska native", "American Indian or Alaska Native"),
    ("asian", "Asian"),
    ("hispanic or latino", "Hispanic or Latino"),
    ("native hawaiian or pacific islander", "Native Hawaiian or Pacific Islander"),
    ("two or more races", "Two or More Races"),
    ("white (non-hispanic)", "White (non-Hispanic)"),
    ("economically disadvantaged", "Economically Disadvantaged"),
    ("english learner", "English Learner"),
    ("foster care", "Foster Care"),
    ("homeless", "Homeless"),
    ("migrant", "Migrant"),
    ("students with disabilities (iep)", "Students with Disabilities (IEP)"),
    ("military dependent", "Military Dependent"),
    ("Non-English Learner or monitored", "Non-English Learner or monitored"),
    ("English Learner or monitored", "English Learner or monitored"),
    ("EL", "English Learner"),
    ("ELL", "English Learner"),
    ("LEP", "English Learner"),
    ("IEP", "Students with Disabilities (IEP)"),
    ("SWD", "Students with Disabilities (IEP)"),
    ("FRL", "Economically Disadvantaged"),
    ("ED", "Economically Disadvantaged"),
    ("Students with Disabilities/IEP without Accomodations", "Students with Disabilities/IEP without Accommodations"),
    ("Students With Disabilities with No Accommodations", "Students with Disabilities/IEP without Accommodations"),
    ("Non Gifted and Talented", "Non-Gifted and Talented"),
    ("Native Hawaiian or Pacific Islan", "Native Hawaiian or Pacific Islander"),
    ("American Indian or Alaska Nativ", "American Indian or Alaska Native"),
]
# Spellings of certain years (first year, last year, label, standard label).
BY_YEAR = [
    (2022, 2023, "Students with Disabilities/IEP without Accomodations", "Students with Disabilities/IEP without Accommodations"),
    (2022, 2023, "Non Gifted and Talented", "Non-Gifted and Talented"),
    (2024, 2024, "Non Economically Disadvantaged", "Non-Economically Disadvantaged"),
    (2024, 2024, "Non English Learner", "Non-English Learner"),
    (2024, 2024, "Non-Foster", "Non-Foster Care"),
    (2024, 2024, "Student without Disabilities (IEP)", "Students without IEP"),
    (2024, 2024, "Students With Disabilities with No Accommodations", "Students with Disabilities/IEP without Accommodations"),
]
# The years whose groups are known, the standard labels that a year lacks, and the spellings it has besides.
YEARS = [2020, 2021, 2022, 2023, 2024]
NOT_IN = {
    2020: ["Non-Military", "Non-Military Dependent", "Non-Gifted and Talented", "Students with Disabilities/IEP Regular Assessment",
           "Students with Disabilities/IEP with Accommodations", "Students with Disabilities/IEP without Accommodations"],
    2021: ["Non-Military", "Non-Military Dependent"],
    2022: ["Non-Military"],
    2023: ["Non-Military"],
}
ALSO_IN = {2024: ["Non Economically Disadvantaged", "Non English Learner", "Student without Disabilities (IEP)"]}
# Groups that every year must have, and groups that may be missing.
REQUIRED = ["All Students", "African American", "American Indian or Alaska Native", "Asian", "Hispanic or Latino",
            "Native Hawaiian or Pacific Islander", "Two or More Races", "White (non-Hispanic)"]
ALLOW_MISSING = [
    "Female", "Male", "English Learner", "Economically Disadvantaged", "Foster Care", "Homeless", "Migrant", "Students with Disabilities (IEP)",
    "Gifted and Talented", "Military Dependent", "English Learner including Monitored", "Non-English Learner or monitored", "Non-Homeless",
    "Non-Migrant", "Non-Military", "Non-Military Dependent", "Non-Gifted and Talented", "Students with Disabilities/IEP Regular Assessment",
    "Students with Disabilities/IEP with Accommodations", "Students with Disabilities/IEP without Accommodations",
    "Non-Economically Disadvantaged", "Non-English Learner", "Non-Foster Care", "Students without IEP",
]

STATE_DIMS = DemographicDims(
    standard=STANDARD, general_map=GENERAL,
    year_map=[(str(y), label, mapped) for first, last, label, mapped in BY_YEAR for y in range(first, last + 1)],
    expected=[(str(y), g) for y in YEARS for g in [*(s for s in STANDARD if s not in NOT_IN.get(y, [])), *ALSO_IN.get(y, [])]],
    required=REQUIRED, allow_missing=ALLOW_MISSING, years=[str(y) for y in YEARS])
