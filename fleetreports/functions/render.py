"""Text renderings of query results (the job's line-oriented output).

Structured columns are the primary result of every query; these projections
turn them into the text lines the text sink writes. Built only from
``concat`` / ``date_format`` / casts, so they stay inside codegen.

Fixed values that must equal the source job's output text (kept together):
  report line : Vehicle{id='<id>', vtype=<n>, ltype=<n>, lat=<d>, lng=<d>,
                bearing=<d>, lineid=<n>, linename='<s>', routeid=<n>,
                course='<s>', lf='<s>', delay=<d>, laststopid=<n>,
                finalstopid=<n>, isinactive='<s>', lastupdate=<date>'}
                (the quote after <date> is part of the original format)
  train line  : trainID:<id> trainName:<linename> last stop:<laststopid> last update:<date>
  top line    : ID:<id> name:<linename> delay:<delay> last update:<date>
  average line: Average delay:<avg>
  gap line    : ID: <id> Average: <avg_gap_s>
  date text   : EEE MMM dd HH:mm:ss zzz yyyy, rendered here in UTC
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_TEXT_PATTERN = "EEE MMM dd HH:mm:ss 'UTC' yyyy"


def date_text(ts: Column) -> Column:
    """Java ``Date.toString`` text of a UTC wall-clock timestamp."""
    return F.date_format(ts, DATE_TEXT_PATTERN)


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def report_line(df: DataFrame) -> Column:
    return F.concat(
        F.lit("Vehicle{id='"), _s("id"),
        F.lit("', vtype="), _s("vtype"),
        F.lit(", ltype="), _s("ltype"),
        F.lit(", lat="), _s("lat"),
        F.lit(", lng="), _s("lng"),
        F.lit(", bearing="), _s("bearing"),
        F.lit(", lineid="), _s("lineid"),
        F.lit(", linename='"), _s("linename"),
        F.lit("', routeid="), _s("routeid"),
        F.lit(", course='"), _s("course"),
        F.lit("', lf='"), _s("lf"),
        F.lit("', delay="), _s("delay"),
        F.lit(", laststopid="), _s("laststopid"),
        F.lit(", finalstopid="), _s("finalstopid"),
        F.lit(", isinactive='"), _s("isinactive"),
        F.lit("', lastupdate="), date_text(F.col("lastupdate")),
        F.lit("'}"),
    )


def train_line() -> Column:
    return F.concat(
        F.lit("trainID:"), _s("id"),
        F.lit(" trainName:"), _s("linename"),
        F.lit(" last stop:"), _s("laststopid"),
        F.lit(" last update:"), date_text(F.col("lastupdate")),
    )


def top_line() -> Column:
    return F.concat(
        F.lit("ID:"), _s("id"),
        F.lit(" name:"), _s("linename"),
        F.lit(" delay:"), _s("delay"),
        F.lit(" last update:"), date_text(F.col("lastupdate")),
    )


def average_line() -> Column:
    return F.concat(F.lit("Average delay:"), _s("avg_delay"))


def gap_line() -> Column:
    return F.concat(F.lit("ID: "), _s("id"), F.lit(" Average: "), _s("avg_gap_s"))


# Query kind -> line builder; ``render`` picks by the columns present.
def render(df: DataFrame, kind: str) -> DataFrame:
    """Project a query result to one ``value`` text column (text sink input)."""
    builders = {
        "report": lambda: report_line(df),
        "train": train_line,
        "top": top_line,
        "average": average_line,
        "gap": gap_line,
    }
    if kind not in builders:
        raise ValueError(f"unknown rendering {kind!r}; expected one of {sorted(builders)}")
    return df.select(builders[kind]().alias("value"))
