"""A small random school district and the reports computed from it row by row in Python."""

from __future__ import annotations

import random
from collections import defaultdict

# The letters and the points of the two scales, in tenths.
LETTERS = ["A+", "A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "F", "P", None]
PARTIAL = {"A": 40, "A-": 37, "B+": 33, "B": 30, "B-": 27, "C+": 23, "C": 20}
FULL = {"A+": 40, "A": 40, "A-": 37, "B+": 33, "B": 30, "B-": 27, "C+": 23, "C": 20, "C-": 17, "D+": 13, "D": 10, "F": 0}


def district(seed: int, hot: bool = False) -> dict[str, list[dict]]:
    """Rows with repeated names, dangling references and, if hot, one course holding a third of the grades."""
    rng = random.Random(seed)
    schools = [{"id": f"s{i}", "name": f"School {i % 3}"} for i in range(4)]
    users = []
    for i in range(40):
        role = ["teacher", "student", "student", "parent", "clerk"][i % 5]
        users.append({"id": f"u{i}", "name": f"{role} {i % 9}", "role": role, "school_id": f"s{rng.randrange(5)}"})
    # The same student listed at a second school.
    users.append({"id": "u1", "name": "student 1", "role": "student", "school_id": "s3"})
    courses = [
        {"id": f"c{i}", "name": f"{rng.choice(['Art', 'Computer Lab', 'Computer Science', 'History', 'Gym'])} {i % 2}",
         "teacher_id": f"u{rng.randrange(0, 45, 5)}", "school_id": "s0"}
        for i in range(12)
    ]

    def enrolment() -> dict:
        course = "c0" if hot and rng.random() < 0.34 else f"c{rng.randrange(14)}"
        return {"course_id": course, "student_id": f"u{rng.randrange(45)}"}

    grades = [{**enrolment(), "id": f"g{i}", "grade": rng.choice(LETTERS)} for i in range(300)]
    homeworks = [{**enrolment(), "id": f"h{i}"} for i in range(200)]
    adjustments = [{**enrolment(), "id": f"a{i}", "action": rng.choice(["add", "drop", "switch"])} for i in range(60)]
    contents = [{"id": f"d{i}", "course_id": "c1", "file_type": rng.choice(["pdf", "mp4", "jpg"])} for i in range(31)]
    return {
        "schools": schools, "users": users, "courses": courses, "grades": grades,
        "homeworks": homeworks, "adjustments": adjustments, "contents": contents,
    }


def _mean(tenths: list[int]) -> float | None:
    return sum(tenths) / (len(tenths) * 10) if tenths else None


def _partial(letters: list) -> float | None:
    return _mean([PARTIAL.get(x, 0) for x in letters])


def _full(letters: list) -> float | None:
    return _mean([FULL[x] for x in letters if x in FULL])


def _subject(name: str) -> str:
    for text, subject in [("Science", "Science"), ("History", "History"), ("Art", "Art"), ("Computer", "Computer Science")]:
        if text in name:
            return subject
    return "Other"


def brute_force(d: dict[str, list[dict]]) -> dict[str, list[tuple]]:
    """Every report by nested loops over the rows."""
    groups: dict[str, dict] = {f"Q{i}": defaultdict(list) for i in range(1, 10)}
    people = defaultdict(list)
    for u in d["users"]:
        people[u["role"]].append(u)
    for c in d["courses"]:
        groups["Q3"][c["name"]] += [h for h in d["homeworks"] if h["course_id"] == c["id"]]
        for g in d["grades"]:
            if g["course_id"] == c["id"]:
                groups["Q1"][c["name"]].append(g["grade"])
                groups["Q8"][_subject(c["name"])].append(g)
        for t in people["teacher"]:
            if t["id"] == c["teacher_id"]:
                mine = [g for g in d["grades"] if g["course_id"] == c["id"]]
                if mine:
                    groups["Q2"][t["name"]] += [g["grade"] for g in mine]
                for s in d["schools"]:
                    if s["id"] == t["school_id"]:
                        groups["Q9"][t["name"], s["name"]].append((c, mine))
    for p in people["parent"]:
        for s in people["student"]:
            if s["school_id"] == p["school_id"]:
                mine = [g["grade"] for g in d["grades"] if g["student_id"] == s["id"]]
                groups["Q4"][p["name"]] += mine or [None]
    for s in people["student"]:
        for a in d["adjustments"]:
            if a["student_id"] == s["id"]:
                groups["Q5"][s["name"]].append(a)
        for school in d["schools"]:
            if school["id"] == s["school_id"]:
                mine = [g for g in d["grades"] if g["student_id"] == s["id"]]
                if mine:
                    groups["Q7"][school["name"]] += mine

    def letters(gs: list[dict]) -> list:
        return [g["grade"] for g in gs]

    def students(gs: list[dict]) -> int:
        return len({g["student_id"] for g in gs})

    result = {
        "Q1": [(k, _partial(v)) for k, v in groups["Q1"].items()],
        "Q2": [(k, _partial(v)) for k, v in groups["Q2"].items()],
        "Q3": [(k, len(v)) for k, v in groups["Q3"].items()],
        "Q4": [(k, len(v), _partial(v)) for k, v in groups["Q4"].items()],
        "Q5": [(k, len(v)) for k, v in groups["Q5"].items()],
        "Q7": [(k, students(v), _full(letters(v)), len(v)) for k, v in groups["Q7"].items()],
        "Q8": [(k, _full(letters(v)), students(v), len(v)) for k, v in groups["Q8"].items()],
        "Q9": [],
    }
    for (teacher, school), taught in groups["Q9"].items():
        gs = [g for _, mine in taught for g in mine]
        courses = len({c["id"] for c, _ in taught})
        result["Q9"].append((teacher, school, courses, students(gs), len(gs), _full(letters(gs))))
    return {q: sorted(v, key=repr) for q, v in result.items()}
