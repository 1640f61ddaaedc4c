"""Layouts as a table function of SQL: the cards of a page by LATERAL (EXT4)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, NullType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from kalends.sources.pages import FIELDS, LAYOUTS, card_fields, read_page

COLUMNS = [*FIELDS, "href", "image"]


class LayoutCards:
    """layout_cards(html, layout): a row per card, with its place on the page from 0.

    The layout is a constant, so a wrong name fails when the query is analysed, not in a task. A null
    page and a page without cards give no row.
    """

    @staticmethod
    def analyze(html: AnalyzeArgument, layout: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(html.dataType, StringType | NullType):
            raise ValueError(f"layout_cards reads a string, not {html.dataType.simpleString()}")
        if not layout.isConstantExpression or layout.value not in LAYOUTS:
            raise ValueError(f"layout_cards needs a constant layout, one of {', '.join(sorted(LAYOUTS))}")
        schema = StructType().add("position", IntegerType())
        for name in COLUMNS:
            schema = schema.add(name, StringType())
        return AnalyzeResult(schema=schema)

    def eval(self, html: str | None, layout: str) -> Iterator[tuple]:
        profile = LAYOUTS[layout]
        for n, card in enumerate(card_fields(read_page(html, profile), profile)):
            yield (n, *(card[c] for c in COLUMNS))


def register(spark: SparkSession, name: str = "layout_cards") -> None:
    """Makes the function known to the session's SQL."""
    spark.udtf.register(name, udtf(LayoutCards))
