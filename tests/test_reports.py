import collections
import random

import pytest

from candlestream.plans import reports
from candlestream.schemas import STUDENT_SCHEMA
from candlestream.sources.files import tab_lines

# A paragraph and its counted words in byte order (fixed values).
TEXT = (
    "The journey of learning programming requires patience and dedication. Many beginners start"
    " with basic languages like Python or JavaScript to understand fundamental concepts. Practice"
    " daily coding challenges helps strengthen problem-solving skills. Understanding data"
    " structures and algorithms is essential for writing efficient code. Collaboration with other"
    " developers through version control systems like Git improves code quality. Reading"
    " documentation and contributing to open-source projects accelerates learning significantly."
    " Debugging skills become valuable when dealing with complex applications. Remember that every"
    " expert programmer started as a beginner. Persistence and continuous learning are keys to"
    " mastering software development and building a successful career in technology."
)
REPEATED = {"a": 2, "and": 5, "learning": 3, "like": 2, "to": 3, "with": 3}
ONCE = (
    "Collaboration Debugging Git JavaScript Many Persistence Practice Python Reading Remember The"
    " Understanding accelerates algorithms applications. are as basic become beginner. beginners"
    " building career challenges code code. coding complex concepts. continuous contributing"
    " control daily data dealing dedication. developers development documentation efficient"
    " essential every expert for fundamental helps improves in is journey keys languages mastering"
    " of open-source or other patience problem-solving programmer programming projects quality."
    " requires significantly. skills skills. software start started strengthen structures"
    " successful systems technology. that through understand valuable version when writing"
).split()


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_golden_word_count(spark):
    want = sorted({**REPEATED, **dict.fromkeys(ONCE, 1)}.items())
    got = [tuple(r) for r in reports.word_count(lines(spark, TEXT)).collect()]
    assert got == want and len(got) == 88
    printed = [r.value for r in tab_lines(reports.word_count(lines(spark, TEXT)), "word", "n").collect()]
    assert printed == [f"{w}\t{n}" for w, n in want]


def test_words_are_what_python_splits(spark):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    near = ["\u200b", "\u180e", "\x08", "\x1b", "\x0e", "\u2027", "\u2030", "\u3001", "\ufeff"]
    rng = random.Random(1)
    texts = ["".join(rng.choices([*blanks, *near, "é", "x", "Y", "."], k=200)) for _ in range(20)]
    want = collections.Counter(w for t in texts for w in t.split())
    got = {r.word: r.n for r in reports.word_count(lines(spark, *texts)).collect()}
    assert got == want


def test_word_count_of_nothing(spark):
    assert reports.word_count(lines(spark, "", "  ", None)).count() == 0


def test_sum_pairs(spark):
    df = lines(spark, "a\t1", "a\tx", "b", "a\t2", " c\t4 ", "d\t1\t2", "e\t1.0", None, "f\t-3")
    assert [tuple(r) for r in reports.sum_pairs(df).collect()] == [("a", 3), ("c", 4), ("f", -3)]


def sales(spark):
    rows = [
        (3, 1.125, "France"), (1, 5.0, "Spain"), (2, 2.5, "Italy"), (9, 9.0, "United Kingdom"),
        (7, 7.0, None), (1, 1.0, "France"),
    ]
    return spark.createDataFrame(rows, "Quantity long, UnitPrice double, Country string")


def test_revenue(spark):
    got = reports.revenue_by_key(sales(spark), exclude="United Kingdom").collect()
    assert [tuple(r) for r in got] == [("Italy", 5.0), ("Spain", 5.0), ("France", 4.38)]
    assert reports.revenue_by_key(sales(spark), exclude="United Kingdom", n=1).first()[0] == "Italy"
    assert reports.revenue_by_key(sales(spark)).count() == 5


def test_exclusion_is_applied_before_the_sum(spark, tmp_path, capsys):
    sales(spark).write.parquet(str(tmp_path / "s"))
    reports.revenue_by_key(spark.read.parquet(str(tmp_path / "s")), exclude="France", n=1).explain()
    plan = capsys.readouterr().out
    assert "Not(EqualTo(Country,France))" in plan and "TakeOrderedAndProject" in plan


@pytest.fixture
def students(spark):
    rows = [  # higher Mjob romantic address G3 studytime Dalc Walc absences goout
        ("yes", "teacher", "no", "U", 15, 4, 1, 2, 11, 5),
        ("yes", "health", "yes", "R", 9, 4, 1, 1, 11, 5),
        ("no", "health", "no", "U", 10, 1, 5, 5, 10, 5),
        ("yes", "teacher", "no", "R", 14, 2, 1, 3, 12, 4),
        ("yes", "other", "yes", "R", None, 3, None, 3, 30, 5),
    ]
    return spark.createDataFrame(rows, STUDENT_SCHEMA)


def test_students(students):
    assert [r.G3 for r in reports.low_grade_applicants(students).collect()] == [9]
    assert reports.study_time_count(students).first().n == 2
    assert [tuple(r) for r in reports.mean_grade(students, "Mjob").collect()] == [
        ("teacher", 14.5), ("health", 9.5), ("other", None)]
    assert dict(map(tuple, reports.mean_grade(students, "romantic", ranked=False).collect())) == {
        "no": 13.0, "yes": 9.0}
    assert [r.Total_Alcohol for r in reports.total_alcohol(students).collect()] == [
        3, 2, 10, 4, None]
    assert [r.Rank for r in reports.grade_class(students).collect()] == [
        "Gioi", "Yeu", "Kha", "Kha", "Yeu"]
    assert [r.G3 for r in reports.absentees(students).collect()] == [9]
    assert sorted(map(tuple, reports.by_address(students).collect())) == [
        ("R", 11.5, 3), ("U", 12.5, 2)]


def test_sql_reports_leave_views_alone_and_keep_their_columns(spark):
    mine = spark.range(3)
    mine.createOrReplaceTempView("students")
    rows = spark.createDataFrame([("U", 9, 11, 5), ("R", 15, 1, 1)], "address string, G3 int, absences int, goout int")
    assert reports.by_address(rows).columns == ["address", "Average_G3", "Student_Count"]
    assert reports.absentees(rows).count() == 1
    assert spark.table("students").count() == 3
