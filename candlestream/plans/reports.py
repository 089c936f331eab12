"""Batch reports: revenue by key, student performance, word count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Grade classes and their lower bounds (fixed values).
GRADE_CLASSES = ((15, "Gioi"), (10, "Kha"))
LOWEST_CLASS = "Yeu"

# What separates words: the characters Unicode calls white space plus the four ASCII
# separators (fixed values), as a regular-expression class. The class tests a character against
# a table up to U+00FF and looks at the rest only between U+1680 and U+3000; as one flat list of
# ranges it takes twice as long.
WORD_BREAK = (
    r"[\x{9}\x{a}\x{b}\x{c}\x{d}\x{1c}\x{1d}\x{1e}\x{1f}\x{20}\x{85}\x{a0}"
    r"[\x{1680}-\x{3000}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]+"
)


def revenue_totals(
    df: DataFrame, key: str = "Country", qty: str = "Quantity", price: str = "UnitPrice"
) -> DataFrame:
    """Revenue per key from order lines, each line rounded to cents.

    The sum has a map-side partial, so a key with a large part of all rows costs one row per
    task.
    """
    line = F.round(F.col(qty) * F.col(price), 2)
    return df.groupBy(key).agg(F.sum(line).alias("Total_Revenue"))


def rank_revenue(
    totals: DataFrame, key: str = "Country", exclude: str | None = None, n: int | None = None
) -> DataFrame:
    """Totals, highest first, ties by key. `exclude` drops that key, and with it NULL keys."""
    if exclude is not None:
        totals = totals.filter(F.col(key) != exclude)
    ranked = totals.orderBy(F.col("Total_Revenue").desc(), F.col(key))
    return ranked if n is None else ranked.limit(n)


def revenue_by_key(
    df: DataFrame,
    key: str = "Country",
    qty: str = "Quantity",
    price: str = "UnitPrice",
    exclude: str | None = None,
    n: int | None = None,
) -> DataFrame:
    """Ranked revenue per key. Catalyst moves the exclusion below the sum, into the scan."""
    return rank_revenue(revenue_totals(df, key, qty, price), key, exclude, n)


def low_grade_applicants(students: DataFrame, below: float = 10) -> DataFrame:
    """Students who want higher education but have a low final grade."""
    return students.where((F.col("higher") == "yes") & (F.col("G3") < below))


def study_time_count(students: DataFrame, level: int = 4) -> DataFrame:
    return students.where(F.col("studytime") == level).agg(F.count("*").alias("n"))


def mean_grade(students: DataFrame, by: str, ranked: bool = True) -> DataFrame:
    means = students.groupBy(by).agg(F.avg("G3").alias("Avg_G3"))
    return means.orderBy(F.col("Avg_G3").desc(), by) if ranked else means


def total_alcohol(students: DataFrame) -> DataFrame:
    return students.withColumn("Total_Alcohol", F.col("Dalc") + F.col("Walc"))


def grade_class(students: DataFrame, classes: Sequence[tuple[float, str]] = GRADE_CLASSES) -> DataFrame:
    """`Rank` of the final grade; a missing grade is the lowest class."""
    rank: Column = F.lit(LOWEST_CLASS)
    for bound, label in reversed(classes):
        rank = F.when(F.col("G3") >= bound, label).otherwise(rank)
    return students.withColumn("Rank", rank)


def absentees(
    students: DataFrame, absences: int = 10, grade: float = 10, outings: int = 4
) -> DataFrame:
    """Many absences, low grade, often out, by SQL. The order of the conditions is fixed."""
    return students.sparkSession.sql(
        "SELECT * FROM {students} WHERE absences > :absences AND G3 < :grade AND goout > :outings",
        args={"absences": absences, "grade": grade, "outings": outings}, students=students,
    )


def by_address(students: DataFrame) -> DataFrame:
    """Mean grade and head count by address, by SQL. Names and order of the columns are fixed."""
    return students.sparkSession.sql(
        "SELECT address, avg(G3) AS Average_G3, count(*) AS Student_Count"
        " FROM {students} GROUP BY address", students=students,
    )


def word_count(df: DataFrame, col: str = "value") -> DataFrame:
    """Words separated by white space and their counts, in byte order of the word."""
    words = df.select(F.explode(F.split(col, WORD_BREAK)).alias("word"))
    return (
        words.filter("word != ''").groupBy("word").agg(F.count("*").alias("n")).orderBy("word")
    )


def sum_pairs(df: DataFrame, col: str = "value") -> DataFrame:
    """Sums of `word<TAB>count` lines per word; lines without a whole-number count are skipped."""
    line = F.regexp_replace(col, f"^{WORD_BREAK}|{WORD_BREAK}$", "")
    parts = F.split(line, "\t", 2)
    return (
        df.select(
            parts[0].alias("word"),
            F.get(parts, 1).alias("count"),
        )
        .select("word", F.trim("count").try_cast("bigint").alias("count"))
        .filter("count IS NOT NULL")
        .groupBy("word").agg(F.sum("count").alias("n")).orderBy("word")
    )
