"""Demographic dimension used with the W fixture (segment labels)."""

from kpiloom.operators.demographics import DemographicDims

# The fixture's standard labels, maps and validation lists.
W_STANDARD = ["All Students", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
W_GENERAL_MAP = [("HOUSEHOL", "HOUSEHOLD"), ("Automobile", "AUTOMOBILE")]
W_YEAR_MAP = [("2001", "Bldg", "BUILDING")]
W_REQUIRED = ["All Students", "BUILDING", "MACHINERY", "TELECOM"]
W_ALLOW_MISSING = ["FURNITURE"]
W_YEARS = [str(y) for y in range(1990, 2011)]

W_DIMS = DemographicDims(
    standard=W_STANDARD,
    general_map=W_GENERAL_MAP,
    year_map=W_YEAR_MAP,
    expected=[(y, lab) for y in W_YEARS for lab in W_STANDARD] + [("2001", "Bldg")],
    required=W_REQUIRED,
    allow_missing=W_ALLOW_MISSING,
    years=W_YEARS,
)
