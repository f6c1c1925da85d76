"""Sources and sinks of the document corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qirtas.functions.text import is_blank, strip

REFERENCE = T.StructType([T.StructField(c, T.StringType()) for c in (
    "relation_type", "source_document_id", "target_document_id", "target_number", "target_document_type", "raw_text", "context")])
DOCUMENT = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "id", "title", "title_ar", "title_en", "title_fr", "date", "document_type", "number", "issuer", "source_url", "language",
        "contentAr", "contentEn", "contentFr", "markdown", "created_at", "updated_at")]
    + [
        T.StructField("language_urls", T.MapType(T.StringType(), T.StringType())),
        T.StructField("pdf_urls", T.ArrayType(T.StringType())),
        T.StructField("cross_references", T.ArrayType(REFERENCE)),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
LANGUAGES = ("ar", "en", "fr", "unknown")
# Headers that are not kept.
PRIVATE_HEADERS = ("cookie", "set-cookie", "authorization", "proxy-authorization")


def read_json_documents(spark: SparkSession, directory: str) -> DataFrame:
    """One document per file; unreadable files are rows with ``_corrupt_record``."""
    rows = spark.read.schema(DOCUMENT).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(directory)
    return rows.withColumn("input_file", F.col("_metadata.file_path"))


def with_markdown(df: DataFrame) -> DataFrame:
    """``markdown`` becomes the content of the document's language where that is missing."""
    for code, column in (("ar", "contentAr"), ("en", "contentEn"), ("fr", "contentFr")):
        df = df.withColumn(column, F.coalesce(F.when(~is_blank(F.col(column)), F.col(column)), F.when(F.col("language") == code, F.col("markdown"))))
    return df


def document_errors() -> Column:
    """What is wrong with a document row; empty if nothing is."""
    checks = (
        (is_blank(F.col("title")), "title is empty"),
        (~F.coalesce(strip(F.col("source_url")).rlike(r"^(?i:https?)://[^/?#]+"), F.lit(False)), "source_url is not an absolute http(s) URL"),
        (~F.coalesce(F.col("language").isin(*LANGUAGES), F.lit(False)), "language is unknown"),
    )
    return F.array_compact(F.array(*[F.when(bad, F.lit(why)) for bad, why in checks]))


def validate(df: DataFrame, errors: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``errors``); nothing is thrown inside a job."""
    checked = df.withColumn("errors", errors)
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def contents_by_language(df: DataFrame) -> DataFrame:
    """(id, language, text): one row per content that is not blank."""
    pairs = F.array(*[F.struct(F.lit(code).alias("language"), F.col(c).alias("text")) for code, c in (("ar", "contentAr"), ("en", "contentEn"), ("fr", "contentFr"))])
    return df.select("id", F.explode(pairs).alias("c")).select("id", "c.*").where(~is_blank(F.col("text")))


def best_content(order: tuple[str, ...] = ("contentEn", "contentAr", "contentFr")) -> Column:
    """The first content that is not blank."""
    return F.coalesce(*[F.when(~is_blank(F.col(c)), F.col(c)) for c in order])


def read_raw_pages(spark: SparkSession, directory: str) -> DataFrame:
    """Raw bodies with their hash and kind, from a folder of downloaded files."""
    files = spark.read.format("binaryFile").load(directory)
    low = F.lower("path")
    kind = F.when(low.rlike(r"\.pdf$"), "pdf").when(low.rlike(r"\.html?$"), "html").otherwise("other")
    return files.select("path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"), kind.alias("kind"), "content")


def is_html(content_type: Column) -> Column:
    c = F.lower(F.coalesce(content_type, F.lit("")))
    return c.contains("text/html") | c.contains("application/xhtml+xml")


def is_pdf(content_type: Column, url: Column, pdf_host: Column | None = None) -> Column:
    """By content type, by the address's end, or by a host that has nothing else."""
    found = F.lower(F.coalesce(content_type, F.lit(""))).contains("application/pdf") | F.lower(url).endswith(".pdf")
    return found if pdf_host is None else found | pdf_host


def raw_extension(content_type: Column, url: Column) -> Column:
    json = F.lower(F.coalesce(content_type, F.lit(""))).contains("json")
    return F.when(is_pdf(content_type, url), ".pdf").when(is_html(content_type), ".html").when(json, ".json").otherwise(".bin")


def write_raw_pages(fetched: DataFrame, path: str) -> DataFrame:
    """Fetched pages (url, status, content_type, headers, body) stored with their hash, size and name, private headers left out.

    One table takes the place of a file and its sidecar per page: a few large files instead of many small ones.
    """
    from qirtas.functions.urls import raw_file_stem

    rows = fetched.select(
        "url", "status", "content_type", public_headers(F.col("headers")).alias("headers"), F.sha2("body", 256).alias("sha256"),
        F.length("body").cast("long").alias("n_bytes"), F.concat(raw_file_stem(F.col("url")), raw_extension(F.col("content_type"), F.col("url"))).alias("name"),
        F.when(is_pdf(F.col("content_type"), F.col("url")), "pdf").when(is_html(F.col("content_type")), "html").otherwise("other").alias("kind"), "body",
    )
    rows.write.mode("append").partitionBy("kind").parquet(path)
    return rows.drop("body")


def write_documents(df: DataFrame, path: str) -> None:
    """One JSON object per document and line, for other programs."""
    df.write.mode("overwrite").json(path)


def public_headers(headers: Column) -> Column:
    return F.map_filter(headers, lambda k, v: ~F.lower(k).isin(*PRIVATE_HEADERS))


def pdf_markdown(title: Column, url: Column, text: Column) -> Column:
    """The Markdown of a PDF's text, or a stub with a warning if there is none."""
    body = F.when(is_blank(text), "> No text could be extracted.").otherwise(text)
    return F.concat_ws("\n\n", F.concat(F.lit("# "), title), F.when(url != "", F.concat(F.lit("Source: "), url)), body)


def write_table(df: DataFrame, path: str, *partition: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition).parquet(path)
