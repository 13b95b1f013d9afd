"""From company tickers to filings and their ingestion messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILING_FORM = "10-K"


def first_entries(catalogue: DataFrame) -> DataFrame:
    """One company per ticker, whatever its case: the first in catalogue order.

    ``catalogue(pos, ticker, cik_str, title)``. The minimum combines before the
    shuffle, so a ticker repeated many times costs one row per task.
    """
    return catalogue.groupBy(F.upper("ticker").alias("ticker_key")).agg(
        F.min_by(F.struct("cik_str", "title"), F.col("pos")).alias("_first")
    )


def resolve_companies(tickers: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Add ``cik`` (ten digits) and ``title``; both NULL for an unknown ticker.

    No broadcast is asked for: adaptive execution picks one from the measured
    size of the reduced catalogue.
    """
    joined = tickers.join(
        first_entries(catalogue), F.upper(tickers["ticker"]) == F.col("ticker_key"), "left"
    )
    number = F.col("_first.cik_str").cast("bigint").cast("string")
    # padding never cuts a longer number
    cik = F.lpad(number, F.greatest(F.lit(10), F.length(number)), F.lit("0"))
    return joined.select(
        *(tickers[c] for c in tickers.columns),
        cik.alias("cik"),
        F.col("_first.title").alias("title"),
    )


def unknown_tickers(tickers: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Tickers without a company, with the reason."""
    keys = catalogue.select(F.upper("ticker").alias("ticker_key")).distinct()
    return tickers.join(
        keys, F.upper(tickers["ticker"]) == F.col("ticker_key"), "left_anti"
    ).withColumn("reason", F.concat(F.lit("ticker not found: "), F.col("ticker")))


def latest_filing(feeds: DataFrame, form: str = FILING_FORM) -> DataFrame:
    """Add ``accession`` (no dashes) and ``primary_document`` of the first exact match.

    ``feeds`` holds the parallel arrays ``forms``, ``accessions`` and
    ``documents`` in feed order; positions beyond the shortest are ignored.
    Both are NULL when no filing matches.
    """
    shortest = F.least(F.size("forms"), F.size("accessions"), F.size("documents"))
    at = F.array_position(F.slice("forms", F.lit(1), shortest), F.lit(form))
    at = F.when(at > 0, at.cast("int"))
    rest = [c for c in feeds.columns if c not in ("forms", "accessions", "documents")]
    return feeds.select(
        *rest,
        F.replace(F.element_at("accessions", at), F.lit("-"), F.lit("")).alias("accession"),
        F.element_at("documents", at).alias("primary_document"),
    )


def latest_filing_rows(filings: DataFrame, form: str = FILING_FORM) -> DataFrame:
    """The same choice over one row per filing ``(company, pos, form, accession, document)``.

    The minimum combines before the shuffle, so no company's feed is gathered.
    """
    first = F.min_by(F.struct("accession", "document"), F.col("pos"))
    return (
        filings.where(F.col("form") == form)
        .groupBy("company")
        .agg(first.alias("_first"))
        .select(
            "company",
            F.replace(F.col("_first.accession"), F.lit("-"), F.lit("")).alias("accession"),
            F.col("_first.document").alias("primary_document"),
        )
    )


def unfiled(companies: DataFrame, latest: DataFrame, company: str, form: str = FILING_FORM) -> DataFrame:
    """Known companies without a filing of the form, with the reason.

    ``companies`` comes from ``resolve_companies``, ``latest`` from ``latest_filing_rows``;
    ``company`` names the id that joins them.
    """
    filed = latest.select(F.col("company").alias("_filed"))
    return (
        companies.where(F.col("cik").isNotNull())
        .join(filed, F.col(company) == F.col("_filed"), "left_anti")
        .withColumn("reason", F.concat(F.lit(f"no {form} filing: "), F.col("ticker")))
    )


def _number(cik: str) -> Column:
    return F.col(cik).cast("bigint").cast("string")


def filing_locations(filings: DataFrame, archive: str) -> DataFrame:
    """Add ``document_id``, ``s3_key`` and ``archive_url`` for resolved filings."""
    ticker = F.upper("ticker")
    return filings.withColumns(
        {
            "document_id": F.concat_ws("-", ticker, F.lit(FILING_FORM.replace("-", "")), "accession"),
            "s3_key": F.concat_ws("/", ticker, "accession", "primary_document"),
            "archive_url": F.concat_ws(
                "/", F.lit(archive), _number("cik"), "accession", "primary_document"
            ),
        }
    )


def filing_messages(filings: DataFrame, bucket: str) -> DataFrame:
    """Typed ingestion messages for located filings."""
    return filings.select(
        "document_id",
        F.lit(bucket).alias("s3_bucket"),
        "s3_key",
        F.upper("ticker").alias("tenant"),
        F.lit(FILING_FORM).alias("doc_type"),
        F.create_map(
            F.lit("company"), F.col("title"), F.lit("accession"), F.col("accession")
        ).alias("metadata"),
    )
