"""Stored pages to raw postings."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake import vocab
from hirelake.functions.markup import (
    first_attribute,
    first_text,
    inner_html,
    let,
    visible_text,
    without_code,
)
from hirelake.functions.text import role_matches
from hirelake.functions.times import publish_time, render_time
from hirelake.operators.dedup import first_per_key
from hirelake.schema import RAW
from hirelake.scratch import materialise

# How the pages mark cards and fields, as (tag, attribute, value).
CARD = ("div", "data-search-sol-meta")
CARD_ID = ("article", "data-job-id")
CARD_TITLE = ("a", "data-automation", "jobTitle")
CARD_COMPANY = ("a", "data-automation", "jobCompany")
CARD_LOCATION = ("a", "data-automation", "jobLocation")
CARD_AGE = ("span", "data-automation", "jobListingDate")
DETAIL_TEXT = ("div", "data-automation", "jobAdDetails")
DETAIL_WORK_TYPE = ("span", "data-automation", "job-detail-work-type")
DETAIL_SALARY = ("span", "data-automation", "job-detail-salary")

DETAIL_FIELDS = ["job_desc", "salary", "work_type"]


def extract_cards(
    pages: DataFrame,
    url_prefix: str,
    country: str | Column,
    scraped_at: str = "scraped_at",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per job card of a search page, cards without title or job id
    dropped. ``pages`` needs ``page_id``, ``html`` and a time column; ``keep``
    names page columns to carry along, such as the search term, so the pages of
    all terms are one table and one job."""

    def fields(card: Column) -> Column:
        age = first_text(card, *CARD_AGE)
        return F.struct(
            first_attribute(card, *CARD_ID).alias("Job_ID"),
            first_text(card, *CARD_TITLE).alias("Role"),
            first_text(card, *CARD_COMPANY).alias("Company"),
            first_text(card, *CARD_LOCATION).alias("Location"),
            let(age, lambda a: render_time(publish_time(a, F.col(scraped_at)))).alias("Publish_Time"),
        )

    # Fields are read before the explode: a filter on its output is not pushed
    # into the extraction, which would run it twice.
    blocks = inner_html(without_code(F.col("html")), *CARD)
    cards = pages.select(
        "page_id", *keep, F.posexplode(F.transform(blocks, fields)).alias("position", "_card")
    )
    return cards.where("_card.Job_ID IS NOT NULL AND _card.Role <> ''").select(
        "page_id",
        "position",
        *keep,
        "_card.*",
        F.concat(F.lit(url_prefix), "_card.Job_ID").alias("URL"),
        (country if isinstance(country, Column) else F.lit(country)).alias("country"),
    )


def matching_roles(
    cards: DataFrame, keywords: Sequence[str] = vocab.ROLE_KEYWORDS, min_matches: int = 2
) -> DataFrame:
    """Cards whose role holds enough of the keywords."""
    return cards.where(role_matches(F.col("Role"), keywords, min_matches))


def extract_details(pages: DataFrame) -> DataFrame:
    """``URL`` and the detail fields of each job page; ``''`` for a missing field."""
    html = F.col("html")

    def texts(blocks: Column, line: str | None = None) -> Column:
        def text(block: Column) -> Column:
            shown = visible_text(block)
            return F.regexp_replace(shown, "\n", line) if line else shown

        return F.transform(blocks, text)

    types = F.transform(inner_html(html, *DETAIL_WORK_TYPE), lambda block: inner_html(block, "a"))
    # The cleaned page is used three times, so Catalyst keeps it a column of its own.
    cleaned = pages.select("page_id", "url", without_code(html).alias("html"))
    return cleaned.select(
        "page_id",
        F.col("url").alias("URL"),
        F.array_join(texts(inner_html(html, *DETAIL_TEXT), "; "), " ").alias("job_desc"),
        F.array_join(texts(inner_html(html, *DETAIL_SALARY)), "; ").alias("salary"),
        F.array_join(texts(F.flatten(types)), "; ").alias("work_type"),
    )


def attach_details(cards: DataFrame, details: DataFrame) -> DataFrame:
    """Each card with the detail fields of its URL, ``''`` where there is no
    detail page. If a URL was stored more than once its first page counts, so
    cards never multiply.
    """
    return _joined(cards, first_per_key(details, ["URL"], ["page_id", *DETAIL_FIELDS]))


def wanted_pages(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """The unparsed detail pages (``page_id``, ``url``, ``html``) of the cards'
    URLs, of each URL the first one."""
    urls = cards.select("URL").distinct()
    asked = pages.join(urls, pages["url"] == urls["URL"], "left_semi")
    return first_per_key(asked, ["url"], ["page_id", "html"]).select("page_id", "url", "html")


def attach_pages(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """As :func:`attach_details`, from unparsed detail pages: only the wanted ones
    are parsed. The cards, which are narrow, are written once for both uses."""
    cards = materialise(cards, "cards")
    return _joined(cards, extract_details(wanted_pages(cards, pages)))


def _joined(cards: DataFrame, details: DataFrame) -> DataFrame:
    """The details are written first: Catalyst then knows their size and
    broadcasts them only if small, and otherwise both sides of the join are plain
    shuffles, which AQE can split where one URL is on many cards."""
    unique = materialise(details.select("URL", *DETAIL_FIELDS), "details")
    return cards.join(unique, "URL", "left").fillna("", DETAIL_FIELDS)


def postings(cards: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cards with details in the raw column order."""
    return cards.select(*RAW.fieldNames(), *keep)
