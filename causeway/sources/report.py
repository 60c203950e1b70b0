"""Markdown report sink: result frames as ordered text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from causeway.operators.ordered import row_number

SPECIFICATION = """\
## Model specification

Segmented regression of the outcome on elapsed time t, one level dummy D_i and one running count timedelta_i
per intervention, estimated by least squares:

    y = const + b*t + sum_i (d_i*D_i + g_i*timedelta_i) + covariates + error

d_i is the level change at intervention i and g_i the change of trend while it lasts. Standard errors allow for
autocorrelation (Bartlett weights). The counterfactual sets all D_i and timedelta_i to zero."""


def text_lines(spark: SparkSession, text: str, section: int) -> DataFrame:
    return spark.createDataFrame(
        [(section, i, line) for i, line in enumerate(text.split("\n"))], "section int, ord bigint, line string")


def markdown_table(df: DataFrame, order: Sequence[str], section: int, digits: int = 4) -> DataFrame:
    """A result frame of any size as Markdown rows (section, ord, line); numbers get fixed decimals.

    ``order`` should be unique; rows that share it keep some order.
    """
    cells = []
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            text = F.format_number(F.col(name), digits)
            text = F.regexp_replace(text, ",", "")
        else:
            text = F.col(name).cast("string")
        cells.append(F.coalesce(text, F.lit("")))
    lines = df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    placed = row_number(lines, [], [F.col(f"_o{i}") for i in range(len(order))], "_place")
    body = placed.select(F.lit(section).alias("section"), (F.col("_place") + 1).alias("ord"), "line")
    head = f"| {' | '.join(df.columns)} |\n|{'|'.join([' --- '] * len(df.columns))}|"
    return text_lines(df.sparkSession, head, section).unionByName(body)


def build_report(spark: SparkSession, title: str, tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Lines of a report: title, specification text and one headed table per entry."""
    out = text_lines(spark, f"# {title}\n\n{SPECIFICATION}\n", 0)
    for i, (heading, table, order) in enumerate(tables):
        out = out.unionByName(text_lines(spark, f"## {heading}\n", 2 * i + 1))
        out = out.unionByName(markdown_table(table, order, 2 * i + 2))
        out = out.unionByName(spark.createDataFrame([(2 * i + 2, 1 << 62, "")], "section int, ord bigint, line string"))
    return out


def write_report(lines: DataFrame, path: str) -> None:
    """Text files whose names, in order, give the report; a small one is a single file."""
    ordered = lines.repartitionByRange("section", "ord").sortWithinPartitions("section", "ord")
    ordered.select("line").write.mode("overwrite").text(path)
