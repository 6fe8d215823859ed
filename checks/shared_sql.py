"""Input derivations written once and run by both engines.

Only the few expressions in which the engines differ go through Dialect.
"""

from __future__ import annotations


class Dialect:
    def __init__(self, name: str):
        self.name = name

    def days(self, later: str, earlier: str) -> str:
        if self.name == "spark":
            return f"datediff({later}, {earlier})"
        return f"date_diff('day', {earlier}, {later})"


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")


def mdy(d: str, sep: str = "/") -> str:
    """'2/3/2026'"""
    return f"(CAST(month({d}) AS STRING) || '{sep}' || CAST(day({d}) AS STRING) || '{sep}' || CAST(year({d}) AS STRING))"


def serial(x: Dialect, d: str) -> str:
    """Spreadsheet serial number of a date as text."""
    days = x.days(d, "DATE '1899-12-30'")
    return f"CAST({days} AS STRING)"


def st_columns(custkey: str = "o_custkey", orderkey: str = "o_orderkey") -> str:
    """Columns of st_enrollment over the orders table."""
    return f"""{orderkey} AS enrollment_seq,
  CASE WHEN {custkey} % 11 = 0 THEN NULL ELSE CAST(100000000 + {custkey} AS STRING) END AS student_universalstudentid,
  CASE WHEN {custkey} % 7 = 0 THEN NULL WHEN {custkey} % 13 = 0 THEN '' ELSE concat('S', CAST(1000000 + {custkey} AS STRING)) END AS studentid,
  CASE WHEN {custkey} % 5 = 0 THEN NULL ELSE concat('N', CAST({custkey} AS STRING)) END AS studentid_nyssis_export,
  concat('F', CAST({custkey} % 97 AS STRING)) AS firstname,
  concat('L', CAST({custkey} % 89 AS STRING)) AS lastname,
  DATE '2008-01-01' + CAST({custkey} % 3650 AS INT) AS person_dob,
  CAST({custkey} % 13 AS STRING) AS grade,
  CASE {orderkey} % 5 WHEN 0 THEN 'Southside Academy' WHEN 1 THEN 'Syracuse Academy of Science' WHEN 2 THEN 'Citizenship & Science Academy' WHEN 3 THEN 'OnTECH Charter High School' ELSE 'District High School' END AS schoolname,
  DATE '2025-06-15' + CAST({orderkey} % 240 AS INT) AS st_studentenrollment_startdate,
  CASE WHEN {orderkey} % 3 = 0 THEN NULL ELSE DATE '2025-06-15' + CAST({orderkey} % 240 + 30 + {orderkey} % 60 AS INT) END AS st_studentenrollment_enddate,
  CASE WHEN {custkey} % 6 = 0 THEN 'LD' END AS schoolyear_disability,
  CASE WHEN {custkey} % 37 = 0 THEN NULL ELSE 100000000 + {custkey} END AS st_nyssis_id"""


ROSTER_COLUMNS = """k, j, c_custkey,
  CASE WHEN j % 23 = 5 THEN NULL WHEN j % 19 = 3 THEN CAST(900000000 + c_custkey AS STRING) WHEN j % 17 = 2 THEN concat(CAST(100000000 + c_custkey AS STRING), '.0') ELSE CAST(100000000 + c_custkey AS STRING) END AS nyssis_id,
  CASE WHEN j % 10 = 0 THEN concat('X', CAST(c_custkey AS STRING)) WHEN j % 12 = 1 THEN NULL ELSE concat('S', CAST(1000000 + c_custkey AS STRING)) END AS student_id,
  concat('F', CAST(c_custkey % 97 AS STRING)) AS first_name, concat('L', CAST(c_custkey % 89 AS STRING)) AS last_name,
  DATE '2008-01-01' + CAST(c_custkey % 3650 AS INT) AS dob, CAST(c_custkey % 13 AS STRING) AS grade,
  CASE j % 9 WHEN 7 THEN NULL WHEN 1 THEN st_studentenrollment_startdate + 3 WHEN 2 THEN st_studentenrollment_startdate - 3 WHEN 3 THEN st_studentenrollment_startdate + 5 WHEN 4 THEN st_studentenrollment_startdate - 5 WHEN 5 THEN st_studentenrollment_startdate + 8 WHEN 6 THEN st_studentenrollment_startdate - 8 ELSE st_studentenrollment_startdate END AS st_entry_date,
  CASE j % 7 WHEN 6 THEN NULL WHEN 1 THEN st_studentenrollment_enddate + 2 WHEN 2 THEN st_studentenrollment_enddate - 2 WHEN 3 THEN st_studentenrollment_enddate + 9 WHEN 4 THEN st_studentenrollment_enddate - 9 WHEN 5 THEN DATE '2026-03-01' ELSE st_studentenrollment_enddate END AS st_exit_date,
  CASE WHEN j % 15 = 4 THEN NULL WHEN c_custkey % 6 = 0 OR j % 21 = 1 THEN 'IEP' END AS iep_code,
  CAST((j % 41) / 40.0 AS DOUBLE) AS charter_fte"""


GEN_ROSTER_COLUMNS = """CASE WHEN j % 3 = 0 THEN NULL ELSE nyssis_id END AS nyssis_id, CASE WHEN j % 3 = 1 THEN NULL ELSE student_id END AS student_id, first_name, last_name, dob, grade"""


def text_roster(x: Dialect) -> str:
    """Rosters as a spreadsheet export would deliver them: text only, mixed date shapes, pseudo-nulls, repeated rows.

    ``copy`` 1 rows repeat a base row: the same enrollment, a re-enrollment 20 days on, or a SPED-only entry.
    """
    def row(copy: int, where: str) -> str:
        entered = "(st_entry_date + CASE WHEN j % 29 = 7 THEN 20 ELSE 0 END)" if copy else "st_entry_date"
        return f"""SELECT k, j, c_custkey, c_custkey * 2 + {copy} AS row_id,
  CASE WHEN j % 31 = 4 THEN 'NA' WHEN j % 33 = 6 THEN '0' WHEN j % 35 = 9 THEN 'Not Found' ELSE nyssis_id END AS nyssis_text,
  CASE WHEN j % 27 = 8 THEN '0' ELSE student_id END AS sid_text,
  CASE WHEN j % 39 = 2 THEN 'NA' ELSE first_name END AS first_text,
  CASE WHEN j % 23 = 5 AND j % 2 = 0 THEN NULL WHEN j % 41 = 3 THEN '0' ELSE last_name END AS last_text,
  concat(' ', grade, ' ') AS grade_text,
  CASE j % 5 WHEN 0 THEN {mdy('dob')} WHEN 1 THEN CAST(dob AS STRING) WHEN 2 THEN {serial(x, 'dob')} WHEN 3 THEN NULL ELSE {mdy('dob', '-')} END AS dob_text,
  CASE j % 3 WHEN 0 THEN {mdy(entered)} WHEN 1 THEN CAST({entered} AS STRING) ELSE {serial(x, entered)} END AS entered_text,
  CASE WHEN j % 2 = 0 THEN {mdy('st_exit_date')} ELSE CAST(st_exit_date AS STRING) END AS withdrew_text,
  CASE WHEN j % 14 = 3 THEN NULL WHEN j % 14 = 5 THEN '' WHEN j % 14 = 6 THEN '0' ELSE CASE k WHEN 0 THEN 'Southside Academy' WHEN 1 THEN 'Citizenship & Science Academy' WHEN 2 THEN 'Syracuse Academy of Science' ELSE 'OnTECH Charter High School' END END AS school_text,
  CASE j % 6 WHEN 0 THEN 'Good' WHEN 1 THEN 'No Good' WHEN 2 THEN 'Not in ST System' WHEN 3 THEN 'NA' END AS status_text,
  CASE WHEN j % 8 = 1 THEN 'checked' END AS notes_text, iep_code AS iep_text,
  CASE WHEN j % 13 = 2 THEN 'x' WHEN j % 13 = 5 THEN concat(CAST(j % 100 AS STRING), '%') ELSE concat('0.', lpad(CAST(j % 1000 AS STRING), 3, '0')) END AS fte_text,
  {"CASE WHEN j % 29 = 11 THEN 'SPED - Not on Gen Roster' ELSE 'Gen Ed' END" if copy else "CASE WHEN c_custkey % 6 = 0 THEN 'SPED' WHEN c_custkey % 15 = 0 THEN NULL ELSE 'Gen Ed' END"} AS sped_text
FROM {{roster}} WHERE {where}"""

    return row(0, "1 = 1") + "\nUNION ALL\n" + row(1, "j % 29 IN (3, 7, 11)")


def messy_values(x: Dialect) -> str:
    """One text per order in one of many shapes of dates, identifiers and pseudo-nulls."""
    d = "CAST(o_orderdate AS DATE)"
    short = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * month({d}) - 2 AS INT), 3)"
    two = f"lpad(CAST(year({d}) % 100 AS STRING), 2, '0')"
    return f"""SELECT o_orderkey AS id, CASE o_orderkey % 29
  WHEN 0 THEN {mdy(d)} WHEN 1 THEN CAST({d} AS STRING) WHEN 2 THEN {mdy(d, '-')} WHEN 3 THEN {serial(x, d)}
  WHEN 4 THEN concat({serial(x, d)}, '.0') WHEN 5 THEN concat(CAST(month({d}) AS STRING), '/', CAST(day({d}) AS STRING), '/', {two})
  WHEN 6 THEN concat(CAST({d} AS STRING), ' 08:30:15') WHEN 7 THEN concat({mdy(d)}, ' 8:30') WHEN 8 THEN replace(CAST({d} AS STRING), '-', '/')
  WHEN 9 THEN replace(CAST({d} AS STRING), '-', '.') WHEN 10 THEN replace(CAST({d} AS STRING), '-', '') WHEN 11 THEN 'N/A' WHEN 12 THEN ''
  WHEN 13 THEN ' null ' WHEN 14 THEN concat('000', CAST(o_orderkey AS STRING)) WHEN 15 THEN concat(' id  ', CAST(o_custkey AS STRING), '#7 ')
  WHEN 16 THEN concat(CAST(o_custkey AS STRING), '.00') WHEN 17 THEN CAST(20000 + o_orderkey % 40000 AS STRING) WHEN 18 THEN '31/12/2010'
  WHEN 19 THEN '2/30/2024' WHEN 20 THEN '02/14/70' WHEN 21 THEN '70000' WHEN 22 THEN '39000' WHEN 23 THEN concat({mdy(d)}, ' 25:10')
  WHEN 24 THEN concat(CAST({d} AS STRING), 'T00:00:00')
  WHEN 26 THEN concat({short}, ' ', CAST(day({d}) AS STRING), ', ', CAST(year({d}) AS STRING)) WHEN 27 THEN concat('February ', CAST(day({d}) AS STRING), ' ', CAST(year({d}) AS STRING)) ELSE o_orderpriority END AS txt, {d} AS day, o_custkey
FROM {{orders}}"""


def landed_lines(x: Dialect) -> str:
    """Roster files line by line: a blank line first in some, a title or a legend in others, footers at the end."""
    return """SELECT concat('file_', CAST(k AS STRING)) AS file, CAST(j + 6 AS INT) AS pos,
  concat(coalesce(nyssis_id, ''), ',', coalesce(student_id, ''), ',', first_name, ',', last_name, ',', grade) AS line FROM {roster} WHERE j % 50 <> 49
UNION ALL SELECT concat('file_', CAST(k AS STRING)), CAST(j + 6 AS INT), CASE WHEN j % 100 = 49 THEN ', ,,,' ELSE 'FTE total,,,,9.5' END FROM {roster} WHERE j % 50 = 49
UNION ALL SELECT DISTINCT concat('file_', CAST(k AS STRING)), 0, CASE k WHEN 0 THEN ',,,,' WHEN 1 THEN 'Color Key: red,,,,' ELSE ',,,,' END FROM {roster}
UNION ALL SELECT DISTINCT concat('file_', CAST(k AS STRING)), 1, CASE k WHEN 2 THEN 'Monthly roster,,,,' ELSE ',,,,' END FROM {roster}
UNION ALL SELECT DISTINCT concat('file_', CAST(k AS STRING)), 2, CASE k WHEN 0 THEN 'NYSSIS ID,Student ID,First Name,Last Name,Grade' WHEN 1 THEN 'NYSSIS,StudentID,FirstName,LastName,Current Grade' WHEN 2 THEN 'StateID,Student_Number,Student First Name,Student Last Name,Grade Level' ELSE 'UniversalStudentID,LocalID,First Name,Last Name,Grade' END FROM {roster}"""
