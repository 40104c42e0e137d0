"""Links of downloaded index pages (columns with ``html`` text)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo.sources.manifest import natural_order

MONTH_LINK = r"""href=["'](\d{4}-\d{2})/["']"""
ZIP_LINK = r"""href=["']([^"']+\.zip)["']"""


def links(pages: DataFrame, pattern: str, html: str = "html") -> DataFrame:
    """Distinct first groups of ``pattern`` over all pages, as column ``link``."""
    found = F.regexp_extract_all(F.col(html), F.lit(pattern), 1)
    return pages.select(F.explode(found).alias("link")).distinct()


def month_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Month folders of index pages, oldest first."""
    return links(pages, MONTH_LINK, html).orderBy("link")


def zip_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Archives of index pages, in natural order."""
    return links(pages, ZIP_LINK, html).orderBy(natural_order(F.col("link")), "link")
