"""Parameters and fixed values shared by the operators.

Everything that changes from one school year (or one installation) to the next is
a dataclass field here, so no date or label is buried inside an expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Fixed value: what counts as white space at the ends of a text, the non-breaking space included.
WHITE_SPACE = " \t\n\r\f\v\u00a0"

# Texts standing for "no value". Each caller of the data uses its own list.
NULLS_AUDIT = ("", "NA", "N/A", "NULL")
NULLS_ROSTER = ("NA", "N/A", "NULL", "null", "")
NULLS_ID = ("", "NA", "NaN", "NULL")
NULLS_EXPORT_ID = ("NA", "NULL", "", "0")
NULLS_EXPORT_NAME = ("NA", "NULL", "")
NULLS_LOOKUP_KEY = ("0", "", "Not Found")

# Header patterns, searched in this order (first pattern wins).
AUDIT_ROSTER_PATTERNS = {
    "nyssis": ["NYSSIS", "NYS ?ID", "STATE ?ID", "UNIVERSAL"],
    "student_id": ["STUDENT.?ID", "LOCAL.?ID", "STUDENT NUMBER"],
    "disability": ["DISABILITY", "CLASSIFICATION", "IEP", "SPED"],
    "entry": ["ENTRY", "ENROLL", "START"],
    "exit": ["EXIT", "WITHDRAW", "DISENROLL", "END"],
}
AUDIT_EXPORT_PATTERNS = {
    "nyssis": ["NYSSIS", "NYS ?ID", "STATE ?ID", "UNIVERSAL"],
    "student_id": ["STUDENT.?ID", "LOCAL.?ID", "STUDENT NUMBER"],
    "universal_id": ["UNIVERSAL.?STUDENT", "STUDENT_?UNIVERSAL"],
    "disability": ["DISABILITY", "CLASSIFICATION", "IEP", "SPED"],
    "entry": ["ENTRY", "ENROLL", "START"],
    "exit": ["EXIT", "WITHDRAW", "DISENROLL", "END"],
}
BILLING_ROSTER_PATTERNS = {
    "nyssis": ["^NYSSIS", "NYSSIS.?ID", "StateID", "Universal.*Student.*ID"],
    "student_id": ["^Student.?ID$", "^StudentID$", "^Student_Number$", "LocalID"],
    "full_name": ["^Full.?Name$"],
    "last_name": ["Student.*Last.*Name", "^Last.?Name$", "^LastName$"],
    "first_name": ["Student.*First.*Name", "^First.?Name$", "^FirstName$"],
    "dob": ["Birth.?Date", "Date.?of.?Birth", "^DOB$", "Person.?DOB"],
    "grade": ["^Grade$", "Current.?Grade", "Grade.?Level"],
    "entry": ["^Entered$", "^Entry.?Date", "^Enroll.?Date", "^Start.?Date$"],
    "exit": ["^Withdrew$", "^Withdrawal", "^Leave.?Date", "^Exit.?Date", "^Withdraw.?Date"],
    "fte": ["Southside.*FTE", "OnTECH.*FTE", "SAS.*FTE", "Charter.*FTE", "^FTE$"],
    "address": ["^Address$", "House.*Number", "^Street$"],
    "city": ["^City$"],
    "zip": ["^Zip"],
    "district": ["District", "Residen"],
    "st_entry": ["^ST.?Entry.?Date$", "^ST.?Entry$", "^ST.?Enroll"],
    "st_exit": ["^ST.?Exit.?Date$", "^ST.?Exit$", "^ST.?Withdraw", "^ST.?Leave"],
    "st_school": ["^SchoolName$", "^School.?Name$"],
}
BILLING_EXPORT_PATTERNS = {
    "nyssis": ["^NYSSIS", "NYSSIS.?ID", "StateID", "Universal.*Student.*ID", "Student_Universal", "UniversalStudentID"],
    "entry": ["Enrollment.*Start", "Start.?Date", "^Entry"],
    "exit": ["Enrollment.*End", "End.?Date", "^Exit"],
    "school": ["SchoolName", "School.?Name", "^School$"],
    "student_id": ["^StudentID$", "^Student.?ID$", "LocalID"],
    "first_name": ["^First.?Name$", "^FirstName$"],
    "last_name": ["^Last.?Name$", "^LastName$"],
    "dob": ["Date.?of.?Birth", "^DOB$", "Person.?DOB", "Birth"],
    "grade": ["^Grade$", "Current.?Grade"],
}
SPED_PATTERNS = {
    "nyssis": ["^NYSSIS$", "^NYSSIS.?ID$", "StateID", "Universal.*Student.*ID"],
    "student_id": ["Student.*Gen.*Ed.*ID", "^Student.?ID$", "^StudentID$", "^Student_Number$"],
}
DISABILITY_PATTERNS = {
    "nyssis": ["Universal.*Student.*ID", "Student_Universal", "UniversalStudentID"],
    "iep_code": ["StudentID.?Disability", "Disability.*ID"],
}
# The wider lists of the other billing reader; columns that only it finds resolve by these.
BILLING_ROSTER_PATTERNS_WIDE = {
    "nyssis": ["NYSSIS", "Universal.*Student.*ID", "StateID"],
    "first_name": ["First.*Name", "FirstName"],
    "last_name": ["Last.*Name", "LastName"],
    "dob": ["Birth", "DOB"],
    "grade": ["Grade"],
    "entry": ["Entry.*Date", "Enroll.*Date", "Entered", "Start"],
    "exit": ["Leave.*Date", "Exit.*Date", "Withdrew", "Withdraw.*Date", "Withdraw$", "^End.*Date"],
    "fte": ["^FTE$", "Southside.*FTE", "Charter.*FTE", "OnTECH.*FTE", "SCSD.*FTE"],
    "address": ["Address", "House", "Street"],
    "city": ["^City$"],
    "zip": ["Zip"],
    "district": ["District"],
    "st_entry": ["^ST.?Entry.?Date$", "^ST.?Entry$", "^ST.?Enroll"],
    "st_exit": ["^ST.?Exit.?Date$", "^ST.?Exit$", "^ST.?Withdraw", "^ST.?Leave"],
    "st_school": ["^School.?Name$", "^SchoolName$"],
}
BILLING_EXPORT_PATTERNS_WIDE = {
    "nyssis": ["Universal.*Student.*ID", "NYSSIS", "StateID"],
    "student_id": ["^StudentID$", "Student.*ID$"],
    "entry": ["Start.*Date", "Entry.*Date", "Enrollment.*Start"],
    "exit": ["End.*Date", "Exit.*Date", "Enrollment.*End"],
    "school": ["SchoolName", "School.*Name"],
    "first_name": ["First.*Name"],
    "last_name": ["Last.*Name"],
    "dob": ["DOB", "Birth"],
    "grade": ["Grade"],
}
SPED_PATTERNS_WIDE = {
    "nyssis": ["NYSSIS", "Universal.*Student.*ID"],
    "student_id": ["Student.*Gen.*Ed.*ID", "Student.*ID"],
}
# A second Entry/Exit column holds the pre-filled system date, unless its header matches the last pattern.
PREPOPULATED_PATTERNS = {
    "st_entry": ["^Entry.?Date|^Enroll.?Date"],
    "st_exit": ["^Exit.?Date|^Withdraw.?Date|^Leave.?Date"],
}
PREPOPULATED_EXCLUDE = "Discrepancy|Variance|Match|Diff"


@dataclass(frozen=True)
class BillingConfig:
    """School-year calendar and grace rules of the billing audit."""

    first_day: date = date(2025, 9, 3)
    grace_deadline: date = date(2025, 9, 6)
    july_start: date = date(2025, 7, 1)
    grace_days: int = 3
    end_date: date = date(2026, 6, 30)
    sheet_end_date: date = date(2026, 6, 26)
    program_weeks: int = 40


@dataclass(frozen=True)
class CharterSpec:
    """How one charter's raw roster maps to the unified template."""

    label: str
    keywords: tuple[str, ...]
    columns: dict[str, str] = field(default_factory=dict)
    full_name: str | None = None
    constants: dict[str, str] = field(default_factory=dict)


# Charter labels, school-name keywords and raw headers.
CHARTERS = (
    CharterSpec(
        "Southside 291462",
        ("southside academy",),
        {
            "NYSSIS ID": "NYSSIS ID", "Student ID": "Student ID", "Last Name": "Student Last Name",
            "First Name": "Student First Name", "Grade Level": "Grade", "DOB": "Birth Date",
            "School Name": "School Name", "Enroll Date": "Entered", "Withdraw Date": "Withdrew",
            "SCSD FTE": "Southside FTE", "Student Status": "Student Status",
            "review_notes": "review_notes", "SPED_Flag": "SPED_Flag",
        },
    ),
    CharterSpec(
        "SAS 291463",
        ("syracuse academy of science", "sas"),
        {
            "NYSSIS ID": "NYSSIS ID", "Student ID": "Student ID", "Last Name": "Last Name",
            "First Name": "First Name", "Grade Level": "Current Grade Level", "DOB": "Date of Birth",
            "School Name": "School Name", "Enroll Date": "Entry Date", "Withdraw Date": "Leave Date",
            "SCSD FTE": "FTE", "Student Status": "Student Status", "SPED_Flag": "SPED_Flag",
        },
    ),
    CharterSpec(
        "SASCCS 291464",
        ("citizenship & science", "citizenship and science", "sasccs"),
        {
            "NYSSIS ID": "NYSSIS ID", "Student ID": "Student ID", "Grade Level": "Current Grade Level",
            "DOB": "Date of Birth", "School Name": "School Name", "Enroll Date": "Entry Date",
            "Withdraw Date": "Leave Date", "SCSD FTE": "Status", "Student Status": "Student Status",
            "SPED_Flag": "SPED_Flag",
        },
        full_name="Full Name",
    ),
    CharterSpec(
        "OnTech 291465",
        ("ontech", "on tech"),
        {
            "NYSSIS ID": "NYSSIS ID", "Student ID": "Studemt ID", "Last Name": "Last Name",
            "First Name": "First Name", "Grade Level": "Grade Level", "DOB": "DOB",
            "Enroll Date": "Enroll Date", "Withdraw Date": "Withdraw Date", "SCSD FTE": "OnTECH FTE",
            "SPED_Flag": "SPED_Flag",
        },
        constants={"School Name": "OnTECH Charter High School"},
    ),
)

# The 16 columns of the unified roster, in order.
UNIFIED_COLUMNS = (
    "Charter_Source Ticket #", "Charter Month", "Source_File", "NYSSIS ID", "Student ID", "Last Name",
    "First Name", "Grade Level", "DOB", "School Name", "Enroll Date", "Withdraw Date", "SCSD FTE",
    "Student Status", "review_notes", "SPED_Flag",
)

# Statistics columns as delivered, and their numeric part.
BRONZE_COLUMNS = (
    "county", "agency", "year", "months_reported", "total_index_crimes", "violent_crimes_total",
    "murder_non_negl_manslaughter", "rape_legacy_definition", "robbery", "aggravated_assault",
    "property_crimes_total", "burglary", "larceny", "motor_vehicle_theft",
)
VIOLENT_PARTS = ("murder_non_negl_manslaughter", "rape_legacy_definition", "robbery", "aggravated_assault")
PROPERTY_PARTS = ("burglary", "larceny", "motor_vehicle_theft")
SILVER_COLUMNS = (
    "county", "agency", "year", "months_reported", "total_index_crimes", "violent_crimes_total",
    "property_crimes_total", "murder_non_negl_manslaughter", "rape_legacy_definition", "robbery",
    "aggravated_assault", "burglary", "larceny", "motor_vehicle_theft", "violent_crime_total",
    "property_crime_total", "crime_category", "decade", "is_county_total", "data_quality_flag",
    "crime_rate_per_100k", "ingested_at", "source_api",
)
