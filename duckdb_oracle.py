"""DuckDB SQL for the registered queries, written from the definitions rather than from the Spark plans."""

from __future__ import annotations

from collections.abc import Callable

# Fixed values of the fixture mapping; a list prints as DuckDB writes it.
SUBJECTS = [
    "Mathematics", "English Literature", "Science", "History", "Art", "Music",
    "Physical Education", "Computer Science", "Foreign Language",
]
LEVELS = ["101", "102", "201", "202", "301", "302", "AP", "Honors", "Remedial"]
CONTENT_KINDS = ["lesson", "assignment", "quiz", "video", "image", "resource"]
FILE_KINDS = ["pdf", "docx", "pptx", "mp4", "jpg", "zip"]
LETTERS = ["A+", "A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "F", "P"]

# The entity views of FIXTURES.md section 3.
ENTITY_VIEWS = f"""
line_items AS (
  SELECT l.*, o.o_custkey, o.o_orderdate FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
schools AS (
  SELECT 'S' || n_nationkey AS id, n_name AS name, r_name AS address
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
users AS (
  SELECT 'T' || s_suppkey AS id, s_name AS name, 'teacher' AS role, 'S' || s_nationkey AS school_id FROM supplier
  UNION ALL SELECT 'V' || n_nationkey, 'Visiting ' || n_name, 'teacher', 'S' || n_nationkey FROM nation
  UNION ALL SELECT 'W' || r_regionkey, 'Substitute ' || r_name, 'teacher', 'S' || r_regionkey FROM region
  UNION ALL SELECT 'U' || c_custkey, c_name, 'student', 'S' || c_nationkey FROM customer
  UNION ALL SELECT 'N' || n_nationkey, 'Newcomer ' || n_name, 'student', 'S' || n_nationkey FROM nation
  UNION ALL SELECT 'P' || c_custkey, 'Family ' || c_mktsegment || ' ' || (c_custkey // 10 % 40), 'parent',
                   'S' || c_nationkey FROM customer
  UNION ALL SELECT 'K' || n_nationkey, 'Clerk ' || n_name, 'clerk', 'S' || n_nationkey FROM nation
),
courses AS (
  SELECT 'C' || p_partkey AS id,
         {SUBJECTS}[CAST(p_partkey % 9 + 1 AS INT)] || ' ' ||
         {LEVELS}[CAST(p_partkey // 9 % 9 + 1 AS INT)] AS name,
         'T' || (p_partkey // 20) AS teacher_id, 'S' || (p_partkey // 20 % 25) AS school_id
  FROM part
  UNION ALL SELECT 'Y' || n_nationkey, 'Orientation ' || n_name, 'V' || n_nationkey, 'S' || n_nationkey FROM nation
),
numbered_documents AS (
  SELECT doc_id, CAST(substr(source, 4) AS INT) % 6 + 1 AS kind FROM documents
),
contents AS (
  SELECT 'D' || doc_id AS id, 'C' || doc_id AS course_id, 'T' || (doc_id // 20) AS teacher_id,
         '/files/C' || doc_id || '/' || {CONTENT_KINDS}[kind] || '_' ||
         doc_id || '.' || {FILE_KINDS}[kind] AS file_path,
         {CONTENT_KINDS}[kind] AS content_type,
         {FILE_KINDS}[kind] AS file_type
  FROM numbered_documents
),
graded_items AS (
  SELECT *, CASE WHEN o_custkey % 20 = 0 THEN o_custkey + 1 ELSE o_custkey END AS s_no,
         CASE WHEN l_partkey // 20 % 10 = 0 THEN l_partkey + 20 ELSE l_partkey END AS c_no
  FROM line_items
),
grades AS (
  SELECT 'G' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id,
         o_orderdate AS created_at, 'C' || c_no AS course_id, 'U' || s_no AS student_id,
         {LETTERS}[CAST((CAST(l_quantity AS INT) - 1) % CASE WHEN s_no % 3 = 1 THEN 6 ELSE 13 END + 1 AS INT)] AS grade
  FROM graded_items
),
handed_in AS (
  SELECT *, CASE WHEN o_custkey % 10 = 0 THEN o_custkey + 1 ELSE o_custkey END AS s_no,
         CASE WHEN l_partkey % 25 = 0 THEN l_partkey + 1 ELSE l_partkey END AS c_no
  FROM line_items
),
homework_copies AS (
  SELECT *, unnest(range(1, CASE WHEN s_no % 3 = 1 THEN 3 ELSE 2 END)) AS copy FROM handed_in
),
homeworks AS (
  SELECT 'H' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || copy AS id,
         o_orderdate AS created_at, 'C' || c_no AS course_id, 'U' || s_no AS student_id,
         CASE l_returnflag WHEN 'A' THEN 'pdf' WHEN 'N' THEN 'docx' WHEN 'R' THEN 'txt' END AS file_type
  FROM homework_copies
),
adjustments AS (
  SELECT 'A' || event_id AS id, ts AS created_at, 'U' || user_id AS student_id, 'C' || (event_id // 5) AS course_id,
         CASE event_type WHEN 'click' THEN 'add' WHEN 'purchase' THEN 'drop' WHEN 'signup' THEN 'switch'
                         WHEN 'view' THEN 'audit' WHEN 'error' THEN 'drop' END AS action
  FROM events
)
"""

# What the reports share: grades with their points in tenths under both scales, people by role, names, subjects.
# The points and ranks of the letters, and the subject rules in order.
REPORT_VIEWS = """
letters(grade, rank, partial_points, full_points) AS (
  VALUES ('A+', 1, NULL, 40), ('A', 2, 40, 40), ('A-', 3, 37, 37), ('B+', 4, 33, 33), ('B', 5, 30, 30), ('B-', 6, 27, 27),
         ('C+', 7, 23, 23), ('C', 8, 20, 20), ('C-', 9, NULL, 17), ('D+', 10, NULL, 13), ('D', 11, NULL, 10), ('F', 12, NULL, 0)
),
subject_rules(position, needle, subject) AS (
  VALUES (1, 'Mathematics', 'Mathematics'), (2, 'English', 'English Literature'), (3, 'Science', 'Science'),
         (4, 'History', 'History'), (5, 'Art', 'Art'), (6, 'Music', 'Music'), (7, 'Computer', 'Computer Science')
),
marks AS (
  SELECT course_id, student_id, created_at, grade, COALESCE(partial_points, 0) AS partial_points, full_points
  FROM grades LEFT JOIN letters USING (grade)
),
students AS (SELECT id AS student_id, name AS student_name, school_id FROM users WHERE role = 'student'),
teachers AS (SELECT id AS teacher_id, name AS teacher_name, school_id FROM users WHERE role = 'teacher'),
parents AS (SELECT name AS parent_name, school_id FROM users WHERE role = 'parent'),
school_names AS (SELECT id AS school_id, name AS school_name FROM schools),
hits AS (
  SELECT id, arg_min(subject, position) AS subject
  FROM courses JOIN subject_rules ON contains(name, needle) GROUP BY id
),
titled_courses AS (
  SELECT id AS course_id, name AS course_name, teacher_id, school_id, COALESCE(subject, 'Other') AS subject
  FROM courses LEFT JOIN hits USING (id)
)
"""


def _mean(points: str) -> str:
    return f"CAST(SUM({points}) AS DOUBLE) / (COUNT({points}) * 10)"


def _decimal_mean(points: str) -> str:
    """Five decimals, rounded half up, as text."""
    rounded = f"(20000 * SUM({points}) + COUNT({points})) // (2 * COUNT({points}))"
    return f"CASE WHEN COUNT({points}) > 0 THEN printf('%d.%05d', CAST({rounded} // 100000 AS BIGINT), CAST({rounded} % 100000 AS BIGINT)) END"


DOUBLE_SHARE = "CAST({0} AS DOUBLE) / 100"
DECIMAL_SHARE = "printf('%d.%02d', CAST({0} // 100 AS BIGINT), CAST({0} % 100 AS BIGINT))"


def _shares(entity: str, key: str, form: str = DOUBLE_SHARE) -> str:
    return f"""
SELECT {key}, n AS count, {form.format("((20000 * n + total) // (2 * total))")} AS percentage
FROM (SELECT {key}, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total FROM {entity} GROUP BY {key})
"""


def _reports(mean: Callable[[str], str], share: str) -> dict[str, str]:
    partial, full = mean("partial_points"), mean("full_points")
    return {
        "Q1": f"SELECT course_name, {partial} AS avg_gpa FROM marks JOIN titled_courses USING (course_id) GROUP BY ALL",
        "Q2": f"""
SELECT teacher_name, {partial} AS avg_gpa
FROM marks JOIN titled_courses USING (course_id) JOIN teachers USING (teacher_id) GROUP BY ALL
""",
        "Q3": """
SELECT course_name, CAST(SUM((SELECT COUNT(*) FROM homeworks h WHERE h.course_id = t.course_id)) AS BIGINT) AS num_homeworks
FROM titled_courses t GROUP BY ALL
""",
        # All pairs of parents and students of a school, each student once per grade.
        "Q4": f"""
WITH children AS (
  SELECT school_id, COALESCE(partial_points, 0) AS partial_points FROM students LEFT JOIN marks USING (student_id)
)
SELECT parent_name, COUNT(*) AS num_children, {partial} AS avg_gpa
FROM parents JOIN children USING (school_id) GROUP BY ALL
""",
        "Q5": "SELECT student_name, COUNT(*) AS num_changes FROM adjustments JOIN students USING (student_id) GROUP BY ALL",
        "Q6": _shares("grades", "grade", share),
        "Q7": f"""
SELECT school_name, COUNT(DISTINCT student_id) AS total_students, {full} AS avg_gpa, COUNT(*) AS total_grades
FROM marks JOIN students USING (student_id) JOIN school_names USING (school_id) GROUP BY ALL
""",
        "Q8": f"""
SELECT subject, {full} AS avg_gpa, COUNT(DISTINCT student_id) AS unique_students, COUNT(*) AS total_assignments
FROM marks JOIN titled_courses USING (course_id) GROUP BY ALL
""",
        "Q9": f"""
SELECT teacher_name, school_name, COUNT(DISTINCT course_id) AS courses_taught,
       COUNT(DISTINCT student_id) AS students_taught, COUNT(grade) AS total_grades_given, {full} AS avg_gpa_given
FROM (SELECT course_id, teacher_id FROM titled_courses) JOIN teachers USING (teacher_id)
JOIN school_names USING (school_id) LEFT JOIN marks USING (course_id) GROUP BY ALL
""",
        "Q10": _shares("contents", "file_type", share),
    }


REPORTS = _reports(_mean, DOUBLE_SHARE)
DECIMAL_REPORTS = {
    f"{q}_decimal": sql for q, sql in _reports(_decimal_mean, DECIMAL_SHARE).items() if q not in ("Q3", "Q5")
}

FEATURES = f"""
WITH graded AS (
  SELECT student_id, COUNT(DISTINCT course_id) AS courses, {_mean("full_points")} AS gpa FROM marks GROUP BY ALL
),
handed AS (SELECT student_id, COUNT(*) AS homeworks FROM homeworks GROUP BY ALL),
moved AS (SELECT student_id, COUNT(*) AS changes FROM adjustments GROUP BY ALL)
SELECT student_id, student_name AS name, school_id, COALESCE(courses, 0)::DOUBLE AS num_courses,
       COALESCE(homeworks, 0)::DOUBLE AS num_homeworks, COALESCE(gpa, 0) AS avg_gpa, COALESCE(changes, 0)::DOUBLE AS num_changes
FROM students LEFT JOIN graded USING (student_id) LEFT JOIN handed USING (student_id) LEFT JOIN moved USING (student_id)
"""


def _bars(report: str, category: str, value: str, pattern: str) -> str:
    return f"SELECT {category} AS category, {value} AS value, printf('{pattern}', {value}) AS label FROM ({REPORTS[report]})"


def _short(name: str) -> str:
    """Last word, '&' taken as a blank."""
    return f"regexp_extract(replace({name}, '&', ' '), '(\\S+)\\s*$', 1)"


def _pie(report: str, category: str) -> str:
    return f"""
SELECT {category} AS category, count, printf('%.1f%%', CAST(count AS DOUBLE) * 100 / SUM(count) OVER ()) AS label
FROM ({REPORTS[report]})
"""


CHARTS = {
    "C1_course": _bars("Q1", "course_name", "avg_gpa", "%.2f"),
    "C1_teacher": _bars("Q2", "teacher_name", "avg_gpa", "%.2f"),
    "C1_homework": _bars("Q3", "course_name", "num_homeworks", "%d"),
    "C1_changes": _bars("Q5", "student_name", "num_changes", "%d"),
    "C1_school_gpa": _bars("Q7", "school_name", "avg_gpa", "%.2f"),
    "C1_school_students": _bars("Q7", "school_name", "total_students", "%d"),
    "C1_subject": _bars("Q8", "subject", "avg_gpa", "%.2f"),
    "C2": f"""
SELECT parent_name, CAST(num_children AS DOUBLE) AS num_children, avg_gpa,
       CASE WHEN row_number() OVER (ORDER BY avg_gpa DESC, parent_name) <= 5
              OR row_number() OVER (ORDER BY num_children, parent_name) <= 2
              OR row_number() OVER (ORDER BY num_children DESC, parent_name) <= 2
            THEN parent_name ELSE {_short('parent_name')} END AS label
FROM ({REPORTS["Q4"]})
""",
    "C3": f"""
SELECT teacher_name, school_name, CAST(courses_taught AS DOUBLE) AS courses_taught,
       CAST(students_taught AS DOUBLE) AS students_taught, avg_gpa_given,
       CAST(total_grades_given AS DOUBLE) AS total_grades_given,
       CASE WHEN row_number() OVER (ORDER BY students_taught DESC, teacher_name, school_name) <= 6
              OR row_number() OVER (ORDER BY avg_gpa_given DESC, teacher_name, school_name) <= 4
            THEN teacher_name ELSE {_short('teacher_name')} END AS label,
       CAST(greatest(50, least(total_grades_given * 2, 600)) AS DOUBLE) AS marker_size
FROM ({REPORTS["Q9"]}) WHERE avg_gpa_given IS NOT NULL
""",
    "C4_grades": f"""
SELECT pie.*, COALESCE(rank, 0) AS sort_key
FROM ({_pie("Q6", "grade")}) pie LEFT JOIN letters ON letters.grade = pie.category
""",
    "C4_contents": _pie("Q10", "file_type"),
}

AUDIT = "TRUE AS is_active, '{}' AS metadata"
FIXED_START = "TIMESTAMP '1995-01-01' AS created_at, TIMESTAMP '1995-01-01' AS updated_at"
OWN_TIME = "created_at, created_at AS updated_at"

INGEST = {
    "S2_users": f"SELECT id, {FIXED_START}, {AUDIT}, name, id || '@school.edu' AS email, role, school_id FROM users",
    "S2_schools": f"SELECT id, {FIXED_START}, {AUDIT}, name, address FROM schools",
    "S2_courses": f"SELECT id, {FIXED_START}, {AUDIT}, name, teacher_id, school_id FROM courses",
    "S2_contents": f"SELECT id, {FIXED_START}, {AUDIT}, course_id, teacher_id, file_path, file_type FROM contents",
    "S2_homeworks": f"""
SELECT id, {OWN_TIME}, {AUDIT}, course_id, student_id,
       '/files/' || course_id || '/' || id || '.' || file_type AS file_path, file_type
FROM homeworks
""",
    "S2_grades": f"""
SELECT id, {OWN_TIME}, {AUDIT}, course_id, student_id, grade, CAST(NULL AS VARCHAR) AS comments FROM grades
""",
    "S2_adjustments": f"SELECT id, {OWN_TIME}, {AUDIT}, student_id, course_id, action FROM adjustments",
}

TABLE_NAMES = {
    "Q1": "avg_grade_per_course",
    "Q2": "avg_grade_per_teacher",
    "Q3": "homework_submission_rate",
    "Q4": "parent_engagement",
    "Q5": "course_load_changes",
    "Q6": "grade_distribution",
    "Q7": "school_performance",
    "Q8": "subject_performance",
    "Q9": "teacher_workload",
    "Q10": "content_analysis",
}

TABLES = {
    **INGEST,
    "S3": "SELECT course_id, COUNT(*) AS n, COUNT(DISTINCT student_id) AS students FROM grades GROUP BY course_id",
    "S4": """
SELECT s.name AS school_name, u.role, COUNT(*) AS n
FROM users u JOIN schools s ON s.id = u.school_id GROUP BY s.name, u.role
""",
    "S5": REPORTS["Q10"],
}

# Dimensions and facts. A key is the position of the natural key in its order.
STAR_VIEWS = """
dim_school AS (
  SELECT row_number() OVER (ORDER BY id) AS school_key, id AS school_id, name,
         CAST(NULL AS VARCHAR) AS type, CAST(NULL AS VARCHAR) AS region
  FROM schools
),
people AS (
  SELECT u.*, row_number() OVER (PARTITION BY role ORDER BY id) AS person_key, school_key
  FROM users u LEFT JOIN dim_school d ON d.school_id = u.school_id
),
dim_student AS (
  SELECT person_key AS student_key, id AS student_id, name, school_key FROM people WHERE role = 'student'
),
dim_teacher AS (
  SELECT person_key AS teacher_key, id AS teacher_id, name, school_key FROM people WHERE role = 'teacher'
),
dim_parent AS (
  SELECT person_key AS parent_key, id AS parent_id, name, school_key FROM people WHERE role = 'parent'
),
dim_course AS (
  SELECT row_number() OVER (ORDER BY course_id) AS course_key, course_id, course_name AS name,
         subject, string_split(course_name, ' ')[-1] AS level, d.school_key, teacher_key
  FROM titled_courses c LEFT JOIN dim_school d ON d.school_id = c.school_id
  LEFT JOIN dim_teacher t ON t.teacher_id = c.teacher_id
),
dim_action AS (
  SELECT row_number() OVER (ORDER BY action) AS action_key, action AS action_name
  FROM (SELECT DISTINCT action FROM adjustments)
),
dim_content AS (
  SELECT row_number() OVER (ORDER BY id) AS content_key, id AS content_id, file_type, content_type,
         course_key, t.teacher_key
  FROM contents c LEFT JOIN dim_course d ON d.course_id = c.course_id
  LEFT JOIN dim_teacher t ON t.teacher_id = c.teacher_id
),
days AS (
  SELECT created_at FROM grades UNION ALL SELECT created_at FROM homeworks UNION ALL SELECT created_at FROM adjustments
),
calendar AS (
  SELECT CAST(unnest(generate_series(CAST(MIN(created_at) AS DATE), CAST(MAX(created_at) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date
  FROM days
),
dim_date AS (
  SELECT CAST(strftime(date, '%Y%m%d') AS INT) AS date_key, date, CAST(week(date) AS INT) AS week,
         CAST(month(date) AS INT) AS month, CAST(quarter(date) AS INT) AS quarter, CAST(year(date) AS INT) AS year,
         strftime(date, '%Y-%m-%d') IN ('1996-01-01', '1996-12-25') AS is_holiday
  FROM calendar
),
fact_grade AS (
  SELECT student_key, course_key, CAST(strftime(created_at, '%Y%m%d') AS INT) AS date_key,
         CAST(full_points AS DOUBLE) / 10 AS grade_numeric, grade AS grade_letter,
         CAST(NULL AS DOUBLE) AS points_earned, CAST(NULL AS DOUBLE) AS points_possible,
         full_points AS tenths
  FROM marks g LEFT JOIN dim_student s ON s.student_id = g.student_id
  LEFT JOIN dim_course c ON c.course_id = g.course_id
),
fact_homework AS (
  SELECT student_key, course_key, CAST(strftime(created_at, '%Y%m%d') AS INT) AS date_key, 1 AS submitted_flag, file_type
  FROM homeworks g LEFT JOIN dim_student s ON s.student_id = g.student_id
  LEFT JOIN dim_course c ON c.course_id = g.course_id
),
fact_course_load_change AS (
  SELECT student_key, course_key, CAST(strftime(created_at, '%Y%m%d') AS INT) AS date_key, action_key, 1 AS change_count
  FROM adjustments g LEFT JOIN dim_student s ON s.student_id = g.student_id
  LEFT JOIN dim_course c ON c.course_id = g.course_id LEFT JOIN dim_action a ON a.action_name = g.action
)
"""


def _per_level(source: str, levels: list[str], measures: str) -> str:
    """One plain GROUP BY per level."""
    return " UNION ALL ".join(
        f"SELECT '{level.removesuffix('_key')}' AS level, CAST({level} AS VARCHAR) AS member, {measures} "
        f"FROM {source} GROUP BY {level}"
        for level in levels
    )


STAR = {
    "K1_dim_date": "SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM dim_date",
    "K2_dim_student": "SELECT * FROM dim_student",
    "K2_dim_teacher": "SELECT * FROM dim_teacher",
    "K2_dim_parent": "SELECT * FROM dim_parent",
    "K3_dim_course": "SELECT * FROM dim_course",
    "K4_dim_school": "SELECT * FROM dim_school",
    "K4_dim_action": "SELECT * FROM dim_action",
    "K4_dim_content": "SELECT * FROM dim_content",
    "K5": "SELECT row_number() OVER (ORDER BY id) AS grade_key, id, grade FROM (SELECT DISTINCT id, grade FROM grades)",
    "K8_fact_grade": "SELECT * EXCLUDE (tenths) FROM fact_grade",
    "K9_fact_homework": "SELECT * FROM fact_homework",
    "K9_fact_course_load_change": "SELECT * FROM fact_course_load_change",
    "K10": "SELECT * EXCLUDE (tenths), date_key // 100 AS month_key FROM fact_grade",
    "K12_fact_content_access": """
SELECT student_key, content_key, CAST(strftime(ts, '%Y%m%d') AS INT) AS date_key, event_type AS access_type,
       COUNT(*) AS access_count
FROM events LEFT JOIN dim_student ON student_id = 'U' || user_id LEFT JOIN dim_content ON content_id = 'D' || (event_id // 10)
GROUP BY 1, 2, 3, 4
""",
    "K11_achievement": _per_level(
        """(SELECT f.*, s.school_key, subject, teacher_key FROM fact_grade f
            LEFT JOIN dim_student s ON s.student_key = f.student_key
            LEFT JOIN dim_course c ON c.course_key = f.course_key)""",
        ["school_key", "subject", "teacher_key", "course_key"],
        f"{_mean('tenths')} AS avg_gpa, COUNT(*) AS num_grades",
    ),
    "K11_homework_rate": _per_level(
        """(SELECT p.*, school_key FROM (
              SELECT DISTINCT student_key, course_key, 1 AS enrolments, 0 AS homeworks FROM fact_grade
              UNION ALL SELECT student_key, course_key, 0, 1 FROM fact_homework) p
            LEFT JOIN dim_student s ON s.student_key = p.student_key)""",
        ["student_key", "course_key", "school_key"],
        """CAST(SUM(homeworks) AS BIGINT) AS num_homeworks, CAST(SUM(enrolments) AS BIGINT) AS num_enrolments,
           CAST(SUM(homeworks) AS DOUBLE) / NULLIF(SUM(enrolments), 0) AS homework_rate""",
    ),
    "K11_course_changes": _per_level(
        """(SELECT f.*, school_key, action_name FROM fact_course_load_change f
            LEFT JOIN dim_student s ON s.student_key = f.student_key
            LEFT JOIN dim_action a ON a.action_key = f.action_key)""",
        ["student_key", "course_key", "school_key"],
        ", ".join(f"COUNT(*) FILTER (action_name = '{a}') AS {a}_count" for a in ("add", "drop", "switch")),
    ),
    "K11_content_mix": """
SELECT content_type, file_type, n AS count, CAST((20000 * n + total) // (2 * total) AS DOUBLE) / 100 AS percentage
FROM (SELECT content_type, file_type, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total
      FROM dim_content GROUP BY ALL)
""",
}

# Row counts of a run's tables.
RUN_TABLES = {
    **{name: REPORTS[q] for q, name in TABLE_NAMES.items()},
    **dict.fromkeys(["student_features", "student_clusters", "dt_predictions"], FEATURES),
    **{
        name: f"SELECT * FROM {name}"
        for name in [
            "dim_school", "dim_teacher", "dim_student", "dim_parent", "dim_course", "dim_action", "dim_content", "dim_date",
            "fact_grade", "fact_homework", "fact_course_load_change",
        ]
    },
    **{f"kpi_{name}": STAR[f"K11_{name}"] for name in ["achievement", "homework_rate", "course_changes", "content_mix"]},
}
STAR["S7"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS num_rows FROM ({body})" for name, body in RUN_TABLES.items()
)

# History of customers as students: everyone from 2020; in 2021 those in debt move to school S0, every seventh
# leaves and every supplier joins.
HISTORY = """
before AS (SELECT 'U' || c_custkey AS student_id, c_name AS name, 'S' || c_nationkey AS school_id, c_custkey, c_acctbal FROM customer),
after AS (
  SELECT student_id, name, CASE WHEN c_acctbal < 0 THEN 'S0' ELSE school_id END AS school_id FROM before WHERE c_custkey % 7 <> 0
  UNION ALL SELECT 'X' || s_suppkey, s_name, 'S' || s_nationkey FROM supplier
)
"""


def _versions(left: str) -> str:
    """All versions after the merge; `left` has the versions of those who left."""
    return f"""
SELECT a.student_id, a.name, a.school_id, CASE WHEN b.student_id IS NULL OR b.school_id <> a.school_id
       THEN '2021-09-01' ELSE '2020-09-01' END AS effective_from,
       '9999-12-31' AS effective_to, TRUE AS is_current
FROM after a LEFT JOIN before b ON a.student_id = b.student_id
UNION ALL
SELECT b.student_id, b.name, b.school_id, '2020-09-01', '2021-09-01', FALSE
FROM before b JOIN after a ON a.student_id = b.student_id WHERE b.school_id <> a.school_id
UNION ALL
SELECT student_id, name, school_id, '2020-09-01', {left} FROM before WHERE c_custkey % 7 = 0
"""


CHANGES = {
    "K6": _versions("'9999-12-31', TRUE"),
    "K6_close_missing": _versions("'2021-09-01', FALSE"),
    "K7": "SELECT * FROM after UNION ALL SELECT student_id, name, school_id FROM before WHERE c_custkey % 7 = 0",
}

CHANGES["K6_versions_last"] = f"""
SELECT CASE WHEN effective_from = '2020-09-01' THEN k.version_key
            ELSE (SELECT COUNT(*) FROM before) + row_number() OVER (PARTITION BY effective_from ORDER BY v.student_id) END AS version_key,
       v.*
FROM ({_versions("'2021-09-01', FALSE")}) v
LEFT JOIN (SELECT student_id, row_number() OVER (ORDER BY student_id) AS version_key FROM before) k ON k.student_id = v.student_id
"""
CHANGES["K5_extend"] = """
SELECT COALESCE(k.student_key, n.student_key) AS student_key, a.student_id, a.name, a.school_id
FROM after a
LEFT JOIN (SELECT student_id, row_number() OVER (ORDER BY student_id) AS student_key FROM before) k ON k.student_id = a.student_id
LEFT JOIN (SELECT student_id, (SELECT COUNT(*) FROM before) + row_number() OVER (ORDER BY student_id) AS student_key
           FROM after WHERE student_id NOT IN (SELECT student_id FROM before)) n ON n.student_id = a.student_id
"""
# Versions from 1993, changed in 1996, and the grades given while they were valid.
AS_OF_VERSIONS = """
  SELECT *, row_number() OVER (ORDER BY student_id, starts) AS version_key FROM (
    SELECT b.student_id, DATE '1993-01-01' AS starts,
           CASE WHEN a.student_id IS NULL OR a.school_id <> b.school_id THEN DATE '1996-01-01' ELSE DATE '9999-12-31' END AS ends
    FROM before b LEFT JOIN after a ON a.student_id = b.student_id
    UNION ALL
    SELECT a.student_id, DATE '1996-01-01', DATE '9999-12-31'
    FROM after a LEFT JOIN before b ON a.student_id = b.student_id WHERE b.student_id IS NULL OR b.school_id <> a.school_id
  )
"""
AS_OF = f"""
SELECT g.id, g.student_id, v.version_key
FROM grades g LEFT JOIN ({AS_OF_VERSIONS}) v
ON v.student_id = g.student_id AND v.starts <= CAST(g.created_at AS DATE) AND CAST(g.created_at AS DATE) < v.ends
"""
# The same after every fifth student turned out to have moved in March 1995.
AS_OF_REPAIRED = f"""
SELECT g.id, g.student_id, v.version_key
FROM grades g LEFT JOIN (
  SELECT o.student_id, o.starts,
         CASE WHEN b.c_custkey % 5 = 0 AND o.starts < DATE '1995-03-01' THEN DATE '1995-03-01' ELSE o.ends END AS ends, o.version_key
  FROM ({AS_OF_VERSIONS}) o LEFT JOIN before b ON b.student_id = o.student_id
  UNION ALL
  SELECT o.student_id, DATE '1995-03-01', o.ends,
         (SELECT COUNT(*) FROM ({AS_OF_VERSIONS})) + row_number() OVER (ORDER BY o.student_id)
  FROM ({AS_OF_VERSIONS}) o JOIN before b ON b.student_id = o.student_id
  WHERE b.c_custkey % 5 = 0 AND o.starts = DATE '1993-01-01'
) v ON v.student_id = g.student_id AND v.starts <= CAST(g.created_at AS DATE) AND CAST(g.created_at AS DATE) < v.ends
"""

STREAM = {
    "K12": """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       'D' || (event_id // 10) AS content_id, event_type AS access_type, COUNT(*) AS access_count
FROM events
GROUP BY 1, 2, 3, 4
""",
}
STREAM["K12_batch"] = STREAM["K12"]
STREAM["K12_recount"] = STREAM["K12"]

PREDICTED = f"""(
SELECT CASE WHEN avg_gpa >= 3.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
       CASE WHEN num_homeworks >= 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM ({FEATURES}))"""
CLUSTERED = f"(SELECT *, CAST(LEAST(num_changes, 3) AS INT) AS cluster FROM ({FEATURES}))"
METRICS = f"""
WITH p AS {PREDICTED},
classes AS (
  SELECT c AS cls, CAST((SELECT COUNT(*) FROM p WHERE label = c) AS DOUBLE) AS actual,
         CAST((SELECT COUNT(*) FROM p WHERE prediction = c) AS DOUBLE) AS predicted,
         CAST((SELECT COUNT(*) FROM p WHERE label = c AND prediction = c) AS DOUBLE) AS hits
  FROM (VALUES (0.0), (1.0)) v(c)
)
SELECT SUM(hits) / SUM(actual) AS accuracy,
       SUM(COALESCE(hits / NULLIF(predicted, 0), 0) * actual) / SUM(actual) AS weighted_precision,
       SUM(COALESCE(hits / NULLIF(actual, 0), 0) * actual) / SUM(actual) AS weighted_recall
FROM classes
"""
COMPANIONS = {
    "M1_students": FEATURES,
    "M3_students": f"""
SELECT student_id, name, avg_gpa, num_courses, num_homeworks, num_changes,
       CASE WHEN avg_gpa >= 3.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM ({FEATURES})
""",
    "M4_rule": METRICS,
    "M5_rule": f"SELECT label, prediction, COUNT(*) AS count FROM {PREDICTED} GROUP BY ALL",
    "C5_rule": f"SELECT cluster, COUNT(*) AS count FROM {CLUSTERED} GROUP BY ALL",
    "C6_rule": " UNION ALL ".join(
        f"SELECT cluster, '{f}' AS feature, ROUND(SUM(CAST({f} AS DECIMAL(24, 10)))::DOUBLE / COUNT(*), 6) AS value "
        f"FROM {CLUSTERED} GROUP BY cluster"
        for f in ["num_courses", "num_homeworks", "avg_gpa", "num_changes"]
    ),
    "C7_rule": f"SELECT num_homeworks, avg_gpa, cluster FROM {CLUSTERED}",
    "C8_rule": " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {m} AS value, printf('%.2f', {m}) AS label FROM ({METRICS})"
        for m in ["accuracy", "weighted_precision", "weighted_recall"]
    ),
    "C9_rule": f"""
SELECT label, COUNT(*) FILTER (prediction = 0) AS predicted_0, COUNT(*) FILTER (prediction = 1) AS predicted_1
FROM {PREDICTED} GROUP BY label
""",
}

ON_ENTITIES = {
    **COMPANIONS,
    **REPORTS,
    **DECIMAL_REPORTS,
    "F1": FEATURES,
    "M2": f"SELECT *, CASE WHEN avg_gpa >= 3.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM ({FEATURES})",
    "M1_facts": f"SELECT COUNT(*) AS n_students, 4::BIGINT AS n_clusters, 0::BIGINT AS lowest, 3::BIGINT AS highest, TRUE AS closer "
    f"FROM ({FEATURES})",
    "M3_facts": f"SELECT COUNT(*) AS n_students, TRUE AS two_classes, TRUE AS beats_one_leaf FROM ({FEATURES})",
    "M6_facts": "SELECT TRUE AS shallow, FALSE AS unnamed, TRUE AS decides",
    **CHARTS,
    **TABLES,
}


# Column of an entity, and the entity whose id it holds.
REFERENCES = [
    ("users", "school_id", "schools"), ("courses", "teacher_id", "users"), ("courses", "school_id", "schools"),
    ("contents", "course_id", "courses"), ("contents", "teacher_id", "users"),
    ("homeworks", "course_id", "courses"), ("homeworks", "student_id", "users"),
    ("grades", "course_id", "courses"), ("grades", "student_id", "users"),
    ("adjustments", "course_id", "courses"), ("adjustments", "student_id", "users"),
]
ENTITY_NAMES = ["users", "schools", "courses", "contents", "homeworks", "grades", "adjustments"]


# Entities of a delivery that left out users and courses, and brought some grades twice.
FAULTY_VIEWS = """
faulty_users AS (SELECT * FROM users WHERE id NOT LIKE '%7'),
faulty_courses AS (SELECT * FROM courses WHERE id NOT LIKE '%3'),
faulty_grades AS (SELECT * FROM grades UNION ALL SELECT * FROM grades WHERE id LIKE '%99'),
faulty_schools AS (SELECT * FROM schools), faulty_contents AS (SELECT * FROM contents),
faulty_homeworks AS (SELECT * FROM homeworks), faulty_adjustments AS (SELECT * FROM adjustments)
"""


def _quarantine() -> str:
    parts = []
    for entity in ENTITY_NAMES:
        broken = ", ".join(
            f"CASE WHEN {c} IS NULL OR {c} NOT IN (SELECT id FROM faulty_{p}) THEN '{c}' END" for e, c, p in REFERENCES if e == entity
        )
        columns = f"concat_ws(',', {broken})" if broken else "''"
        counted = f"SELECT '{entity}' AS entity, {columns} AS columns FROM faulty_{entity}"
        parts.append(f"SELECT entity, columns, COUNT(*) AS n_rows FROM ({counted}) GROUP BY entity, columns")
    return " UNION ALL ".join(parts)


INTEGRITY = {
    "S2_orphans": " UNION ALL ".join(
        f"SELECT '{e}' AS entity, '{c}' AS column_name, {c} AS missing_id, COUNT(*) AS n_rows "
        f"FROM faulty_{e} WHERE {c} NOT IN (SELECT id FROM faulty_{p}) GROUP BY {c}"
        for e, c, p in REFERENCES
    ),
    "S2_repeated_ids": " UNION ALL ".join(
        f"SELECT '{e}' AS entity, id, COUNT(*) AS n_rows FROM faulty_{e} GROUP BY id HAVING COUNT(*) > 1" for e in ENTITY_NAMES
    ),
    "S2_quarantine": _quarantine(),
    "S3_differences": """
SELECT 'grade' AS column_name, 'missing' AS problem, 'string' AS declared, 'string' AS found, COUNT(*) AS n_rows FROM grades WHERE id LIKE '%7'
UNION ALL SELECT 'points', 'extra', NULL, 'int', COUNT(*) FROM grades WHERE id LIKE '%7'
UNION ALL SELECT 'comments', 'missing', 'string', NULL, COUNT(*) FROM grades
UNION ALL SELECT 'updated_at', 'retyped', 'timestamp_ntz', 'string', COUNT(*) FROM grades
""",
    "S2_unknown_member": "SELECT c.name, COUNT(*) AS n_changes FROM adjustments a "
    "LEFT JOIN faulty_courses c ON c.id = a.course_id GROUP BY c.name",
}


def oracle_sql() -> dict[str, str]:
    entity_views = f"{ENTITY_VIEWS.strip()},\n{REPORT_VIEWS.strip()}"
    star_views = f"{entity_views},\n{STAR_VIEWS.strip()}"
    dated_views = f"{entity_views},\n{HISTORY.strip()}"
    by_months = {
        "S7_incremental": ON_ENTITIES["Q7"], "S7_incremental_homework": ON_ENTITIES["Q3"],
        "S7_incremental_letters": ON_ENTITIES["Q6"], "S7_incremental_contents": ON_ENTITIES["Q10"],
        "S7_incremental_changes": ON_ENTITIES["Q5"],
        "S7_resume": ON_ENTITIES["Q7"],
        "S7_fingerprints": " UNION ALL ".join(
            f"SELECT '{e}' AS table_name, COUNT(*) AS n_rows, TRUE AS same_moved, FALSE AS same_changed FROM {e}" for e in ENTITY_NAMES
        ),
        "S7_student_bitmaps": f"SELECT subject, unique_students FROM ({ON_ENTITIES['Q8']})",
    }
    groups = [
        (entity_views, ON_ENTITIES | by_months), (f"{entity_views},\n{FAULTY_VIEWS.strip()}", INTEGRITY), (star_views, STAR), (HISTORY.strip(), CHANGES), (dated_views, {"K8_fact_grade_asof": AS_OF, "K8_repaired": AS_OF_REPAIRED}),
    ]
    texts = {
        name: f"WITH {views}\nSELECT * FROM (\n{body.strip()}\n)"
        for views, bodies in groups
        for name, body in bodies.items()
    }
    return texts | {name: body.strip() for name, body in STREAM.items()}
